"""Repeated rows, reused and missing ids, clashing columns, empty tables and hot groups."""

import random

import pytest
from pyspark.sql import functions as F

from panelloom.llm import decontaminate, minhash, quality, secret_scan
from tests.llm.conftest import prose
from tests.llm.test_jobs import brute_classes, brute_leaks, edited


def test_hot_buckets_of_unlike_documents(docs_of):
    """Documents of one template, most of them under the similarity: leads settle few, rare elements the rest."""
    r = random.Random(11)
    template = prose(40, 160).split()
    rows = []
    for k in range(90):
        words = list(template)
        for _ in range(r.choice([2, 5, 9, 14])):  # slots filled from a small pool: their elements are not unique
            words[r.randrange(len(words))] = r.choice(["alpha", "beta", "gamma"])
        rows.append((k, " ".join(words)))
    want = brute_classes(rows)
    for rounds in (1, 2, 3):
        more = [] if rounds == 2 else rows[::7] + [(3, None), (4, "  ")]  # repeated rows, and ids of a text and of none
        got = minhash.near_duplicates(docs_of(rows + more), lead_rounds=rounds).collect()
        assert len(got) == len(rows + more) and {x.doc_id: x.class_id for x in got if (x.doc_id, x.class_id) not in ((3, 3), (4, 4))} == {i: c for i, c in want.items() if (i, c) not in ((3, 3), (4, 4))}
    assert 5 < len(set(want.values())) < 90


@pytest.mark.parametrize("similarity", [0.8, 0.6, 0.9])
def test_prefix_pairs_hold_all_similar_pairs(spark, similarity):
    """Groups around pivots, of rows near and far: all similar pairs of different labels are among those met, and few others."""
    r = random.Random(3)
    sets, group, heads = [], [], []
    for g in range(14):
        base = r.sample(range(1000 * g, 1000 * g + 500), r.randint(10, 60))
        heads.append(len(sets))
        slots = r.sample(range(1000 * g + 600, 1000 * g + 640), 6)
        for k in range(26):
            lost = r.choice([0.02, 0.1, 0.2, 0.6])
            kept = [e for e in base if not k or r.random() > lost]
            if k > 1 and r.random() < 0.6:  # a copy of a copy
                kept = [e for e in sorted(sets[-1]) if r.random() > 0.04]
            more = r.sample(slots, r.randint(0, 2)) + [r.randrange(10**6, 10**9) for _ in range(r.randint(0, 3))] if k else []
            sets.append(set(kept + more) or {g})
            group.append(heads[g])
    jaccard = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    label = [group[i] if jaccard(i, group[i]) >= similarity else i for i in range(len(sets))]
    counts = {}
    for s in sets:
        for e in s:
            counts[e] = counts.get(e, 0) + 1
    own = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "id long, elements array<long>")
    labels = spark.createDataFrame(list(enumerate(label)), "id long, label long")
    rows = [(i, len(s), sum(counts[e] > 1 for e in s), label[i], len(s & sets[group[i]]), group[i]) for i, s in enumerate(sets) if i not in heads]
    rows = spark.createDataFrame(rows, "rep long, size long, common long, label long, pivot long, pivot_id long")
    got = {(x.a, x.b) for x in minhash.prefix_pairs(rows, own, labels, similarity).collect()}
    every = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if group[i] == group[j] and label[i] != label[j] and not {i, j} & set(heads)}
    want = {(i, j) for i, j in every if jaccard(i, j) >= similarity}
    assert len(want) > 50 and want <= got <= every
    assert similarity < 0.8 or len(got) < len(every) / 2


def test_clashing_columns(spark, docs_of):
    a = prose(30, 90)
    df = docs_of([(1, a), (1, a), (2, a), (3, prose(31, 90))], extra=True)
    for name in ("__id", "__key", "__n", "__kept", "__leak", "id_", "key_", "turn", "doc", "digest", "__n2"):
        df = df.withColumn(name, F.lit(name))
    out = minhash.keep_one(df)
    assert out.columns == df.columns and sorted(x.doc_id for x in out.collect()) == [1, 3]
    bench = spark.createDataFrame([(7, prose(31, 90))], "item_id long, text string").withColumn("doc", F.lit(1)).withColumn("item", F.lit(1)).withColumn("id", F.lit(1))
    clean = decontaminate.remove_leaks(df, bench)
    assert clean.columns == df.columns and sorted(x.doc_id for x in clean.collect()) == [1, 1, 2]


def test_repeated_rows_by_their_text(docs_of):
    """The judge of a row is its text, not its id alone."""
    a, z = prose(20, 90), prose(21, 90)
    got = sorted((x.doc_id, x.text) for x in minhash.keep_one(docs_of([(1, a), (1, a), (5, z), (5, a), (5, z)])).collect())
    assert got == [(1, a), (5, z)]


def test_leaks_go_by_rows(spark, docs_of):
    item, clean, other = prose(300, 40), prose(401, 60), prose(402, 60)
    rows = [(None, clean), (None, f"{other} {item}"), (3, clean), (3, f"{clean} {item} {other}"), (4, None), (4, other), (5, item), (5, item)]
    bench = spark.createDataFrame([(1, item), (None, None)], "item_id long, text string")
    left = sorted(((x.doc_id, x.text) for x in decontaminate.remove_leaks(docs_of(rows), bench).collect()), key=str)
    assert left == sorted([(None, clean), (3, clean), (4, None), (4, other)], key=str)
    assert {x.doc_id for x in decontaminate.find_leaks(docs_of(rows), bench).collect()} == {None, 3, 5}


def test_leaks_beside_shared_boilerplate(spark, docs_of):
    """Passages that all items and many documents share bring no document into question, and hide no leak."""
    shared = prose(900, 60)
    items = [(k, f"{shared} {prose(910 + k, 14)}") for k in range(12)]
    rows = [(k, f"{prose(1000 + k, 40)} {shared}") for k in range(20)] + [(100 + k, f"{prose(1100 + k, 30)} {items[k][1]} {prose(1200 + k, 30)}") for k in range(12)]
    got = {(x.doc_id, x.item_id) for x in decontaminate.find_leaks(docs_of(rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute_leaks(rows, items) and {(100 + k, k) for k in range(12)} <= got


def test_shingle_map_knows_all(spark):
    r = random.Random(4)
    some = [r.getrandbits(64) - 2**63 for _ in range(3000)]
    held = decontaminate.ShingleMap(spark.createDataFrame([(h,) for h in some], "h long"))
    every = spark.createDataFrame([(h,) for h in some + [r.getrandbits(64) - 2**63 for _ in range(20_000)]], "h long")
    assert 3000 <= every.where(held.may_hold(F.col("h"))).count() < 3000 + 40


@pytest.mark.parametrize("stage", [quality.keep_good, minhash.keep_one, secret_scan.redact])
def test_stages_on_nothing(stage, docs_of):
    df = docs_of([], extra=True)
    out = stage(df)
    assert out.columns == df.columns and out.count() == 0


def test_pipeline_on_nothing(spark, tmp_path, docs_of):
    import corpus_pipeline

    docs_of([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_stages_on_odd_rows(spark, tmp_path, docs_of):
    """Nulls in any column, repeated rows, ties, a very long text and clashing columns pass every stage."""
    import corpus_pipeline

    good = [(i, prose(100 + i, 150)) for i in range(25)]
    rows = good + [good[0], (None, prose(300, 150)), (26, None), (27, ""), (28, "x" * 200_000), (29, " ".join(prose(i, 400) for i in range(400, 450))), (30, good[3][1]), (31, good[3][1])]
    docs = docs_of(rows, extra=True).withColumn("source", F.when(F.col("doc_id") % 2 == 0, F.col("source")))
    spark.createDataFrame([(1, prose(900, 40)), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"], name
    left = sorted(((x.doc_id, len(x.text)) for x in docs.collect()), key=str)
    assert [i for i, _ in left if i is not None] == sorted([*range(25), 29], key=str) and [i for i, _ in left].count(None) == 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(left)
