"""Texts that are long, odd or hostile, held against the libraries and against brute-force versions."""

import hashlib
import html
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelloom.llm import html_extract, pieces, quality, queries, secret_scan, token_store
from tests.llm.conftest import prose
from tests.llm.test_maps import brute_base, brute_secrets

# --- quality ---------------------------------------------------------------------------------


def test_base_figures_at_every_white_space():
    for code in [*range(0x20), 0x7F, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2030), 0x205F, 0x2060, *range(0x2FF0, 0x3010), 0xFEFF, 0x1F600]:
        text = f"a{chr(code)}b c{chr(code)}d a{chr(code)}b c{chr(code)}d a{chr(code)}b\n{chr(code)}\nx\n{chr(code)}"
        m = quality.measure(text)
        assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"]) == brute_base(text), hex(code)


def brute_verdict(text, lang, references):
    """The verdict of the rules, from character counts and word counts alone."""
    n_words, *_, repeated = brute_base(text)
    if n_words < 50 or 100 * repeated > 50 * n_words:
        return False, None, None
    if lang is not None and lang not in references:
        return True, None, None

    def kind(c):
        if c in " \t\n\x0b\x0c\r":
            return "space"
        if c in "#*$%&|<>":
            return "symbol"
        if ord(c) > 0x3000:
            return "letter"
        return quality.CLASSES[quality._classes[ord(c)]]

    classes = np.array([sum(kind(c) == k for c in text) for k in quality.CLASSES], float)
    words = " ".join(re.findall(r"[^\x20\x09-\x0D]+", text)).lower().split()
    common = [sum(w in (v, v + ",", v + ".") for w in words) for v in quality.VOCABULARY]
    common = np.array([*common, len(words) - sum(common)], float)

    def distance(p, q):
        p, q = p / p.sum(), np.array(q) / np.sum(q)
        entropy = lambda x: -sum(v * np.log2(v) for v in x if v > 0)
        return np.sqrt(max(0, entropy((p + q) / 2) - (entropy(p) + entropy(q)) / 2))

    against = [references[lang]] if lang is not None else list(references.values())
    by_class = min(distance(classes, r["classes"]) for r in against)
    usable = [r for r in against if 1 - r["common"][-1] >= 0.1]
    by_common = min(distance(common, r["common"]) for r in usable) if usable and n_words >= 100 else None
    return not (by_class > 0.28 or (by_common or 0) > 0.45), by_class, by_common


def test_verdicts_equal_brute_force(spark):
    r = random.Random(12)
    rows = [(i, prose(800 + i, 120), "en") for i in range(30)]
    for i in range(60):
        words = prose(900 + i, r.randint(40, 160), False).split()
        share = r.random()
        rows.append((100 + i, " ".join(w + r.choice(["***", "%%", "9", "é"]) if r.random() < share else w for w in words), r.choice(["en", None, "de"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    references = quality.learn_references(docs)
    got = {x.doc_id: x for x in quality.quality_rules(docs).collect()}
    kept = set()
    for i, text, lang in rows:
        want, by_class, by_common = brute_verdict(text, lang, references)
        assert got[i].kept == want, i
        if by_class is not None:
            assert got[i].class_distance == pytest.approx(by_class, abs=1e-6) and (by_common is None) == (got[i].common_distance is None)
        kept.add(want)
    assert kept == {True, False}


# --- pieces ----------------------------------------------------------------------------------


def test_pieces_of_long_words():
    import resource

    import sentencepiece

    model = pieces.PieceModel(pieces.default_model())
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    r = random.Random(1)
    blob = "".join(r.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=1_000_000))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert model.encode([blob])[0].tolist() == library.encode(blob)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000
    for text in ("日本語文字列" * 20_000, blob[:5000] + " " + blob[:5000] + "x " + blob[:4000], "é" * 9_999 + "\n" * 9_999):
        assert model.encode([text])[0].tolist() == library.encode(text)
    assert not any(len(w) > 64 for w in model.cache)


# --- token store -----------------------------------------------------------------------------


def test_token_query_equals_the_plain_library(spark, tmp_path):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(token_store.default_tokenizer())
    r = random.Random(2)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "hello", "World,", " ", "\n", "İ", "é́", " ", "<|", "日本"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randint(0, 12)))) for i in range(200)] + [(300, "hello <|endoftext|> world"), (301, None)]
    spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x for x in queries.op3_token_store(spark, str(tmp_path)).collect()}
    start = 0
    for i, t in rows:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 1]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), t
        start += len(ids)
    assert 49407 in whole.encode(rows[-2][1], add_special_tokens=False).ids


def test_rows_of_one_id_fill_several_shards(docs_of):
    rows = [(None, prose(i, 60)) for i in range(120)] + [(i, prose(i, 60)) for i in range(40)]
    manifest = token_store.write_shards(docs_of(rows), shards=8)
    got = sorted(token_store.read_shards(manifest).collect(), key=lambda x: x.start)
    assert [x.doc_id for x in got] == [None] * 120 + list(range(40)) and manifest.count() > 4
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))


# --- secrets ---------------------------------------------------------------------------------


def brute_links(text, reach=300, min_entropy=3.5):
    """All pairs of parts: a weak one counts when a complement in its scope begins or ends within reach."""
    strong = secret_scan.base_spans(text)
    weak = secret_scan.weak_parts(text, min_entropy)
    scopes = [m.start() for m in re.finditer(r"\n[ \t\r]*\n", text)]
    scope = lambda at: sum(b <= at for b in scopes)
    secret = lambda kind: secret_scan.SORTS[kind] == "secret"
    out = set()
    for a, b, kind in weak:
        if any(s < b and a < e for s, e, _ in strong):
            continue
        if any(secret(k) != secret(kind) and scope(s) == scope(a) and s <= b + reach and e >= a - reach for s, e, k in strong + weak):
            out.add((a, b, kind))
    return out


def test_links_equal_all_pairs():
    r = random.Random(7)
    hexa = lambda: "".join(r.choices("0123456789abcdef", k=32))
    mixed = lambda n=40: "".join(r.choices("abcXYZ0123456789defKLM", k=n))
    bits = [
        lambda: f"https://h.example.com/{hexa()}", lambda: f"https://h.example.com/{'p/' * r.randint(0, 300)}", lambda: f"token={mixed(12)}", lambda: mixed(), lambda: mixed(700),
        lambda: "AKIA" + "Q7" * 8, lambda: "user=bob", lambda: hexa(), lambda: "\n\n", lambda: "plain words here " * r.randint(1, 12), lambda: "my.bucket.amazonaws.com", lambda: "client_id: " + mixed(8),
    ]
    linked = 0
    for _ in range(400):
        text = r.choice([" ", "\n", "="]).join(r.choice(bits)() for _ in range(r.randint(1, 14)))
        strong, found = secret_scan.scan_text(text)
        assert secret_scan.joined(strong) == brute_secrets(text)
        assert set(found) == brute_links(text), text
        linked += len(found)
    assert linked > 300
    # a key in the path of an endpoint leaves the endpoint a complement of the secret beside it
    text = f"https://api.example.com/{'0123456789abcdef' * 2}\nwJalrXUtnFEMI7K7MDENGbPxRfiCYEXAMPLEKEY9"
    assert [k for _, _, k in secret_scan.scan_text(text)[1]] == ["weak_secret"]


def test_scans_take_linear_time():
    unit = f"https://h.example.com/{'0123456789abcdef' * 2} token=abcdefgh12 user=bob wJalrXUtnFEMI7K7MDENGbPxRfiCYEXAMPLEKEY9 "
    for text in (unit * 8_000, "a.b-" * 250_000 + ".amazonaws.com", "A" * 1_000_000 + "===", "0123abc" * 100_000):
        began = time.perf_counter()
        secret_scan.scan_text(text)
        assert time.perf_counter() - began < 6
    assert secret_scan.bucket_hosts("x Abc.s3.eu-west.amazonaws.com, b..c.amazonaws.com .amazonaws.com") == [(6, 30), (35, 50)]


# --- HTML ------------------------------------------------------------------------------------


def brute_lines(weights, width, threshold):
    """Lines between surge and dive, by the definition, line by line."""
    total = lambda i: sum(weights[i : i + width])
    keep = set()
    for i in range(len(weights)):
        if weights[i] and total(i) > threshold:  # a surge: back to where the rise begins, on to the dive
            start = i
            while start and weights[start - 1]:
                start -= 1
            end = i
            while end < len(weights) and (weights[end] or total(end) > threshold):
                end += 1
            keep |= set(range(start, end))
    return [i in keep for i in range(len(weights))]


def test_surges_and_dives_equal_brute_force():
    r = random.Random(5)
    for _ in range(3000):
        weights = [r.choice([0, 0, 3, 20, 45, 90]) for _ in range(r.randint(0, 14))]
        width, threshold = r.choice([1, 2, 3, 4]), r.choice([10, 80])
        assert html_extract.between_surge_and_dive(weights, width, threshold) == brute_lines(weights, width, threshold), weights


def random_page(r, article):
    """A page of known main text: blocks between an opening and an end, with furniture around and within."""
    say = lambda n: " ".join(r.choices(["river", "stone", "a < b", "café", "R&D", "light,", "x"], k=n))
    furniture = [
        lambda: "<nav><ul>" + "".join(f'<li><a href="/{i}">{html.escape(say(1))}</a></li>' for i in range(4)) + "</ul></nav>", lambda: f'<div class="ad">{html.escape(say(30))}</div>',
        lambda: f'<aside><p>{html.escape(say(40))}</p></aside>', lambda: f'<div id="cookie-notice">{html.escape(say(25))}<button>Yes</button></div>', lambda: f"<form><label>{html.escape(say(20))}</label><input></form>",
        lambda: f'<section class="comments"><h2>Readers</h2><p>{html.escape(say(50))}</p></section>', lambda: f'<script>var x = "<p>{"word " * 40}</p>";</script>', lambda: f"<style>p > a {{ x: {'y' * 99} }}</style>",
        lambda: f"<!-- <p>{'hidden ' * 20}</p> -->",
    ]
    texts, body = [], []
    for k in range(r.randint(1, 8)):
        t = say(r.choice([1, 3, 60]) if article or k else 60)
        texts.append(t)
        tag = r.choice(["p", "h2", "blockquote", "div", 'p title="a > b"', *(["p class=related"] if article else [])])
        name = tag.split()[0]
        inner = html.escape(t, quote=False).replace(" ", r.choice([" ", "\n  ", " <b> ", "<br>"]), 1)
        body.append(f"<{tag}>{inner}</{name}>")
        if article and r.random() < 0.4:
            body.append(r.choice(furniture)())
    around = lambda: "".join(r.choice(furniture)() for _ in range(r.randint(0, 3)))
    o, c = r.choice([("<article>", "</article>"), ("<main>", "</main>"), ('<div class="article-body">', "</div>")]) if article else ("<div>", "</div>")
    title = '<div class="article-header"><h1>Head</h1></div>' if article else ""
    page = f"<html><head><title>T</title></head><body><header>Site name</header>{around()}{o}{title}{''.join(body)}{c}{around()}<footer>&copy; all of it</footer></body></html>"
    return page, "\n\n".join((["Head"] if article else []) + [" ".join(t.split()) for t in texts])


def test_main_text_of_known_pages():
    r = random.Random(9)
    for article in (True, False):
        for _ in range(400):
            page, text = random_page(r, article)
            assert html_extract.extract_text(page) == text, page


def test_pages_without_an_article():
    long = "A text of some length that goes on for a while, as texts in articles do, and then ends."
    page = f"<ul><li>Home<li>About</ul><p>Short lead.</p><p>Two.</p><p>Three.</p><p>Four.</p><p>{long}</p><p>End.</p><ul><li>Copyright</ul>"
    assert html_extract.extract_text(page) == f"Short lead.\n\nTwo.\n\nThree.\n\nFour.\n\n{long}\n\nEnd."
    assert html_extract.extract_text(f'<p><a href="/">Home</a> <a href="/a">About us</a></p><p>{long}</p><p>© 2024 Someone</p>') == long
    assert html_extract.extract_text(f"<p>{long}</p><nav>menu</nav><p>Stray.</p>") == long
    assert html_extract.extract_text(f"<p>{long}</p><div class=ad>Buy</div><p>More.</p><p>{long}</p>") == f"{long}\n\nMore.\n\n{long}"


def test_odd_markup():
    x = html_extract.extract_text
    assert x("<p title=don't>hello there</p>") == "hello there"
    assert x('<article><div class="article-header"><h1>Head</h1></div><p class="related">rel</p><label>lab</label><p>x</p></article>') == "Head\n\nrel\n\nlab\n\nx"
    assert x("<article><p class=ad>one<p>two</article>") == "one\n\ntwo" and x("<div><p class=ad>one<p>two</div>") == "two"
    assert x("text <a b='") == "text" and x("<article>a <!-- b") == "a"
    for page in ('<a b="' * 100_000, "<a b='" * 100_000 + ">", "<div>" * 100_000 + "x", "</div>" * 100_000 + "<div>" * 50_000, "<p>" * 200_000 + "a", "<article>" + "<li>x" * 50_000, "<" * 500_000, "<!" * 200_000):
        began = time.perf_counter()
        x(page)
        assert time.perf_counter() - began < 5, page[:10]


def test_pages_query(spark, tmp_path):
    r = random.Random(3)
    rows = [(i, f"u{i}", *random_page(r, i % 2 == 0)) for i in range(40)] + [(90, None, None, ""), (91, "u", "", "")]
    spark.createDataFrame(rows, "page_id long, url string, html string, want string").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op10_html_extract(spark, str(tmp_path)).collect()
    assert sorted((x.page_id, x.text, x.n_chars) for x in got) == [(i, t, len(t)) for i, _, _, t in rows]
    assert hashlib.md5(got[0].text.encode()).hexdigest() and spark.read.parquet(f"{tmp_path}/pages.parquet").where(F.col("html").isNull()).count() == 1
