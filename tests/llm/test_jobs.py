"""Operators that shuffle or write files: near-duplicates, decontamination, token shards, WARC packages, the pipeline."""

import io
import itertools
import random
import re
import zipfile
import zlib

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import functions as F

from panelloom.llm import decontaminate, minhash, token_store, warc
from tests.llm.conftest import prose


def elements(text):
    words = (text or "").lower().split()
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
    seen = {}
    return {(g, seen.setdefault(g, itertools.count()).__next__()) for g in grams}


def brute_classes(rows):
    """Classes by all pairs: similarity 0.8 or more over all shingles, and equal texts."""
    label = {i: i for i, _ in rows}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    sets = [(i, elements(t), t) for i, t in rows]
    for (i, a, s), (j, b, t) in itertools.combinations(sets, 2):
        if a and b and (s == t or len(a & b) >= 0.8 * len(a | b)):
            x, y = root(i), root(j)
            label[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in rows}


def edited(text, r, n):
    words = text.split()
    for _ in range(n):
        words[r.randrange(len(words))] = f"edit{r.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates_equal_all_pairs(docs_of):
    r = random.Random(4)
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "one two"), (5, "one two"), (6, "One  two"), (7, "x " * 30_000)]
    for g in range(12):
        base = prose(1000 + g, 60 + 15 * g)
        rows += [(100 * g + 100 + k, edited(base, r, r.choice([0, 0, 1, 1, 2, 3]))) for k in range(9)]
    rows += [(5000 + k, prose(5000 + k, 80)) for k in range(20)]
    r.shuffle(rows)
    got = minhash.near_duplicates(docs_of(rows, extra=True)).collect()
    assert {x.doc_id: x.class_id for x in got} == brute_classes(rows) and len(got) == len(rows)


def test_near_duplicates_without_leads(docs_of):
    """Pairs that no lead resolves are checked one by one."""
    r = random.Random(6)
    base = prose(77, 90)
    rows = [(k, edited(base, r, 1)) for k in range(40)]
    got = minhash.near_duplicates(docs_of(rows), lead_rounds=1).collect()
    assert {x.doc_id: x.class_id for x in got} == brute_classes(rows)


def test_near_duplicates_odd_tables(docs_of):
    assert minhash.near_duplicates(docs_of([])).count() == 0
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None)]
    got = sorted(((x.doc_id, x.class_id) for x in minhash.near_duplicates(docs_of(rows)).collect()), key=str)
    assert got == [(1, 1), (1, 1), (2, 2), (None, None)]


def test_one_of_each_class_stays(docs_of):
    base = prose(9, 120)
    df = docs_of([(1, base), (2, base), (3, edited(base, random.Random(1), 1)), (4, prose(10, 90)), (5, None)], extra=True)
    out = minhash.keep_one(df)
    assert out.columns == df.columns and sorted(x.doc_id for x in out.collect()) == [1, 4, 5]


def test_one_of_repeated_rows_and_reused_ids(docs_of):
    a, b, c, d = (prose(20 + k, 90) for k in range(4))
    near = edited(a, random.Random(2), 1)
    rows = [(1, a), (1, a), (2, b), (2, b), (3, near), (3, c), (4, d), (4, None), (4, None), (5, d), (5, b), (6, c + " tail"), (None, a)]
    got = sorted(((x.doc_id, x.text) for x in minhash.keep_one(docs_of(rows)).collect()), key=str)
    assert got == sorted([(1, a), (2, b), (3, c), (4, d), (4, None), (None, a)], key=str)
    # two texts that only share their smallest id are not one class
    got = sorted((x.doc_id, x.text) for x in minhash.keep_one(docs_of([(7, a), (7, b), (8, near), (9, b)])).collect())
    assert got == sorted([(7, a), (7, b)])


def test_signatures_estimate_weighted_similarity():
    r = random.Random(2)
    shared = np.array([r.getrandbits(63) for _ in range(600)], np.uint64)
    own = np.array([r.getrandbits(63) for _ in range(200)], np.uint64)
    a, b = np.concatenate([shared, own[:100]]), np.concatenate([shared, own[100:]])
    sig = minhash.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), 2048)
    assert abs((sig[0] == sig[1]).mean() - 600 / 800) < 0.05
    assert (minhash.signatures(a, np.array([len(a)]), 2048)[0] == sig[0]).all()  # alone or in a batch
    tiny = minhash.signatures(np.array([5, 9], np.uint64), np.array([1, 1]), 160)
    assert not (tiny[0] == tiny[1]).any()


def test_components_of_a_chain(spark):
    ids = list(range(40))
    random.Random(1).shuffle(ids)
    edges = spark.createDataFrame(list(itertools.pairwise(ids)), "a long, b long")
    nodes = spark.createDataFrame([(i, i) for i in range(41)], "id long, label long")
    assert {x.id: x.label for x in minhash.components(nodes, edges, "t").collect()} == dict.fromkeys(range(40), 0) | {40: 40}


def brute_leaks(docs, items, similarity=0.8):
    """Every window as long as the item, at every place: the share of the item's weighted shingles in it."""
    cut = lambda t: [w for w in re.split(r"[^\w]+", (t or "").lower()) if w]
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    each = [(i, cut(t)) for i, t in items]
    df = {}
    for _, w in each:
        for g in set(grams(w)):
            df[g] = df.get(g, 0) + 1
    n = len({i for i, w in each if grams(w)})
    found = set()
    for d, t in docs:
        words = cut(t)
        for i, w in each:
            own = grams(w)
            for s in range(max(1, len(words) - len(w) + 1)):
                window = grams(words[s : s + len(w)])
                weight = lambda g: np.log1p(n / df[g])
                if own and sum(weight(g) * min(own.count(g), window.count(g)) for g in set(own)) >= similarity * sum(weight(g) * own.count(g) for g in set(own)):
                    found.add((d, i))
                    break
    return found


def test_leaks_equal_every_window(spark, docs_of):
    r = random.Random(8)
    items = [(k, prose(300 + k, 15 + 3 * k)) for k in range(10)] + [(90, None), (91, "too short"), (92, prose(300, 15))]
    rows = [(1, None), (2, ""), (3, "one two three")]
    for k in range(40):
        body = prose(2000 + k, 60).split()
        if k % 2:
            inner = items[k % 10][1].upper() if k % 3 == 0 else items[k % 10][1]
            body[20:20] = (edited(inner, r, 1) if k % 4 == 1 else inner).split()
        rows.append((10 + k, " ".join(body)))
    rows += [(100, items[4][1]), (101, " ".join(items[6][1].split()[:-2])), (102, prose(1, 3000) + " " + items[5][1])]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("h", F.lit(1))
    got = decontaminate.find_leaks(docs_of(rows, extra=True), bench).collect()
    assert {(x.doc_id, x.item_id) for x in got} == brute_leaks(rows, items)
    assert all(x.similarity >= 0.8 for x in got) and len({(x.doc_id, x.item_id) for x in got}) == len(got)
    df = docs_of(rows, extra=True)
    clean = decontaminate.remove_leaks(df, bench)
    assert clean.columns == df.columns and {x.doc_id for x in clean.collect()} == {i for i, _ in rows} - {x.doc_id for x in got}


def test_leaks_of_repeated_items(spark, docs_of):
    """Rows that stand twice, an id with two texts and a null id lose nothing."""
    texts = [prose(300 + k, 30) for k in range(5)]
    items = [(1, texts[0]), (1, texts[0]), (2, texts[1]), (2, texts[2]), (None, texts[3]), (4, texts[4]), (4, texts[4].upper())]
    rows = [(10 + k, prose(400 + k, 40) + " " + t + " " + prose(500 + k, 40)) for k, t in enumerate(texts)] + [(20, texts[1] + " " + texts[2]), (21, prose(7, 90))]
    df, bench = docs_of(rows), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((x.doc_id, x.item_id) for x in decontaminate.find_leaks(df, bench).collect()), key=str)
    assert got == [(10, 1), (11, 2), (12, 2), (13, None), (14, 4), (20, 2)]
    assert [x.doc_id for x in decontaminate.remove_leaks(df, bench).collect()] == [21]


def test_leaks_of_items_with_a_template(spark, docs_of):
    """Items that share most of their shingles: fingerprints alone would lose windows without the template."""
    r = random.Random(17)
    fresh = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
    template = fresh(36)
    own = [fresh(20) for _ in range(100)]
    items = [(k, " ".join(template + o)) for k, o in enumerate(own)]
    rows = [(k, " ".join(fresh(40) + template[-4:] + o + fresh(4))) for k, o in enumerate(own[:30])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_leaks(rows, items)
    assert len(want) == 30
    alone = decontaminate.find_leaks(docs_of(rows), bench, radius=0).collect()
    assert {(x.doc_id, x.item_id) for x in alone} == want == {(x.doc_id, x.item_id) for x in decontaminate.find_leaks(docs_of(rows), bench).collect()}
    assert max(x.distance for x in alone) > decontaminate.RADIUS


def test_leaks_of_nothing(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(docs_of([(1, prose(1, 60))]), none).count() == 0
    assert decontaminate.find_leaks(docs_of([]), spark.createDataFrame([(1, prose(1, 30))], "item_id long, text string")).count() == 0


def test_blocks_find_all_within_the_radius(spark):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(6)]
    near = []
    for n in range(300):
        h = base[n % 6]
        for b in r.sample(range(64), r.randint(0, 26)):
            h ^= 1 << b
        near.append(h)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    windows = spark.createDataFrame([(str(k), signed(h)) for k, h in enumerate(near)], "key string, fp long")
    items = spark.createDataFrame([(k, signed(h)) for k, h in enumerate(base)], "item long, fp long")
    got = {(int(x.key), x.item, x.distance) for x in decontaminate.hamming_pairs(windows, items, 22).collect()}
    assert got == {(k, i, (h ^ b).bit_count()) for k, h in enumerate(near) for i, b in enumerate(base) if (h ^ b).bit_count() <= 22}


def test_token_shards(spark, docs_of):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(token_store.default_tokenizer())
    whole.encode_special_tokens = True
    r = random.Random(5)
    odd = ["", None, "word,. x.,", "<|endoftext|> a", "it's WE'LL don't...", "İ, ab", "a b", "Straße éa 3.14, ab.", "z" * 50_000]
    rows = [(7 * i % 101, "".join(r.choice("abzTHe's  \n\t.,#*éÑ́日\x1c1 39<|>") for _ in range(r.randint(0, 60)))) for i in range(100)]
    rows += [(1000 + i, t) for i, t in enumerate(odd)] + [(2000 + i, prose(i, 60)) for i in range(60)]
    manifest = token_store.write_shards(docs_of(rows, extra=True), shards=5)
    got = sorted(token_store.read_shards(manifest).collect(), key=lambda x: x.doc_id)
    start = 0
    assert [x.doc_id for x in got] == sorted(i for i, _ in rows)
    for x, (i, t) in zip(got, sorted(rows, key=lambda p: p[0]), strict=True):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 1]
        assert (x.start, x.n_tokens, x.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), repr(t)[:60]
        start += len(ids)
    assert manifest.count() == 5
    assert token_store.read_document(spark, manifest, 2003) == [*whole.encode(prose(3, 60), add_special_tokens=False).ids, 1]
    assert token_store.read_document(spark, manifest, -5) is None


def test_token_shards_of_odd_tables(docs_of):
    assert token_store.read_shards(token_store.write_shards(docs_of([]))).count() == 0
    got = token_store.read_shards(token_store.write_shards(docs_of([(None, "a"), (3, "b"), (3, "b"), (1, None)]), shards=3)).collect()
    assert sorted(((x.doc_id, x.start) for x in got), key=lambda p: p[1]) == [(None, 0), (1, 2), (3, 3), (3, 5)]


def test_damaged_shard_is_refused(docs_of):
    manifest = token_store.write_shards(docs_of([(1, "a b c")]), shards=1)
    uri = manifest.first().uri
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as f:
        raw = f.read()
    with fs.open_output_stream(path) as f:
        f.write(raw[:-3])
    try:
        token_store.ShardReader(uri)
    except ValueError as e:
        assert "no whole shard" in str(e)
    else:
        raise AssertionError("a cut shard was read")


def test_warc_round_trip(spark):
    rows = [(5, "http://a/1", "same é"), (3, "http://a/2", "same é"), (9, None, None), (8, "http://a b/\n", ""), (4, "u", "other"), (None, "u", "same é"), (None, "u", "alone"), (6, "u", "x" * 300_000), (4, "u", "other")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("id", F.lit("z"))
    for zip64 in (False, True):
        manifest = warc.write_packages(pages, zip64=zip64)
        got = warc.read_packages(manifest).collect()
        assert len(got) == len(rows) == sum(r.n_records for r in manifest.collect())
        want = []
        for i, _, t in rows:
            raw = (t or "").encode()
            same = [j for j, _, u in rows if (u or "") == (t or "") and j is not None]
            refers = min(same) if same and i != min(same) else None
            want.append((i, len(raw), warc.payload_digest(raw), "revisit" if refers is not None else "response", refers))
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
        fs, path = pafs.FileSystem.from_uri(manifest.first().uri)
        with fs.open_input_file(path) as f:
            z = zipfile.ZipFile(io.BytesIO(f.read()))
        assert z.namelist() == [warc.DATA, warc.INDEX] and z.testzip() is None and all(m.compress_type == 0 for m in z.infolist())
    reader = warc.PackageReader(manifest.first().uri)
    offset, length, uri = list(reader.index())[-1]
    assert warc.decode_record(reader.record(offset, length))[0]["WARC-Record-ID"] == f"<{uri}>"
    assert warc.read_packages(warc.write_packages(pages.limit(0))).count() == 0


def test_short_payloads_are_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    got = {r.page_id: r.record_type for r in warc.read_packages(warc.write_packages(pages, min_revisit=4)).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_zip_of_another_writer():
    """A directory with a comment and deflated members, as other tools write it."""
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("a.txt", b"hello")
        z.writestr("b.txt", b"x" * 100, compress_type=zipfile.ZIP_DEFLATED)
        z.comment = b"note PK\x05\x06 in a comment"

    class File:
        def size(self):
            return len(raw.getvalue())

        def read_at(self, n, at):
            return raw.getvalue()[at : at + n]

    d = warc.ZipDirectory(File())
    at, n = d.place("a.txt")
    assert raw.getvalue()[at : at + n] == b"hello"
    try:
        d.place("b.txt")
    except ValueError:
        pass
    else:
        raise AssertionError("a deflated member was placed")


def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline
    from panelloom.llm import pieces, quality

    bench = [(k, prose(300 + k, 30)) for k in range(4)]
    base = prose(50, 120)
    rows = [(i, prose(100 + i, 150), "en") for i in range(40)]
    rows += [(100, base, "en"), (101, base, "en"), (102, edited(base, random.Random(1), 1), "en"), (103, "short", "en"), (104, None, None)]
    rows += [(110, prose(60, 80) + " " + bench[1][1] + " " + prose(61, 50), "en"), (111, prose(62, 100) + ' password = "hunter2hunter2" ' + prose(63, 40), "en")]
    rows += [(120, " ".join(w + "###" for w in prose(70, 150, False).split()), "en")]
    docs = spark.createDataFrame([(i, t, g, "s", len(t or "")) for i, t, g in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    judge = quality.Judge(quality.learn_references(docs), 0.28, 0.45, 50, 100, 0.1)
    kept = [(i, t) for i, t, g in rows if judge(t, g)["kept"]]
    classes = brute_classes(kept)
    kept = [(i, t) for i, t in kept if classes[i] == i]
    leaked = {d for d, _ in brute_leaks(kept, bench)}
    kept = [(i, t) for i, t in kept if i not in leaked]
    assert set(got) == {i for i, _ in kept} and {101, 102, 103, 104, 110, 120}.isdisjoint(got) and {100, 111, *range(40)} <= set(got)
    model = pieces.model_of(pieces.default_model())
    text = model.decode(np.array(got[111].ids))
    assert "hunter2" not in text and "[SECRET]" in text
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "secret_scan", "sentencepiece"]


def test_workers_keep_nothing_of_other_operators(spark, docs_of):
    """Workers outlive their tasks: idle ones held the words of the signatures and the pieces' model with its caches."""
    from panelloom.llm import pieces

    def held(batches):
        import os

        import pyarrow as pa

        from panelloom.llm import minhash, pieces

        for _ in batches:
            kept = sum(len(m.cache) for m in pieces._models.values())
            yield pa.RecordBatch.from_pydict({"pid": [os.getpid()], "words": [len(minhash._words)], "cached": [kept]})

    look = lambda: spark.range(0, 64, 1, 16).mapInArrow(held, "pid long, words long, cached long").collect()
    docs = docs_of([(k, prose(k, 60)) for k in range(64)]).repartition(16).localCheckpoint()
    pieces.encode(docs).write.format("noop").mode("overwrite").save()
    assert any(x.cached for x in look())  # the next task of the same operator finds them
    minhash.bands_of(docs, "doc_id", "text").write.format("noop").mode("overwrite").save()
    after = [(x.pid, x.words, x.cached) for x in look()]
    assert not any(words for _, words, _ in after)
    own = docs.mapInArrow(minhash.lean(held), "pid long, words long, cached long").collect()
    assert not any(x.words or x.cached for x in own)
