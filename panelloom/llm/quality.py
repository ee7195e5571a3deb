"""Quality rules by distribution divergence.

Two histograms of a document, its character classes and its common words, are held against references
learned from all documents of its language. The distance is Jensen-Shannon (square root of the
divergence, base 2, from 0 to 1). A document is rejected when a distance is over its threshold; short
documents, whose histograms say little, are guarded: each rule only speaks above a least length.

Defined cases: a null or empty text has no words and fails the base rule; a document without a language
is held against every reference and the nearest counts; one whose language has too few documents for a
reference is judged by the base rule alone; an empty table gives an empty result;
repeated rows are judged one by one; other columns of the input are never read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, portions

# Frequent function words of the languages that have a common-word rule.
COMMON_WORDS = {
    "en": "the of and to a in is that for it was on are with as be by at this not or from have an",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se avec",
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus",
}
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
CLASSES = ("lower", "upper", "accented", "digit", "space", "punctuation", "symbol", "letter", "odd_space", "other")
_TABLE_SIZE = 0x3001  # one past the last white space there is, U+3000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = list(dict.fromkeys(w for words in COMMON_WORDS.values() for w in words.split()))


def _class_table() -> np.ndarray:
    """Class of each code point below ``_TABLE_SIZE``; its last entry stands for all above."""
    def kind(c: str) -> str:
        if c in SPACES:
            return "space"
        if c in SYMBOLS:
            return "symbol"
        if c.isspace():
            return "odd_space"
        if c.isdigit():
            return "digit"
        if c.isalpha():
            return "upper" if c.isupper() else "letter" if not c.islower() else "lower" if c.isascii() else "accented"
        return "punctuation" if unicodedata.category(c)[0] == "P" else "other"

    return np.array([CLASSES.index(kind(chr(i))) for i in range(_TABLE_SIZE)] + [CLASSES.index("letter")], np.int8)


_classes = _class_table()


def character_classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(_classes[np.minimum(codes, _TABLE_SIZE)], minlength=len(CLASSES))


def common_words(words: Counter) -> np.ndarray:
    """Counts of the common words, with or without a comma or full stop behind; then all other words."""
    counts = [words[w] + words[w + ","] + words[w + "."] for w in VOCABULARY]
    return np.array([*counts, words.total() - sum(counts)], np.float64)


def repeated_window_words(words: list[str], width: int = 3) -> int:
    """Words that stand in a window of ``width`` words which the text holds twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    index: dict[str, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    if len(index) < 2**21:  # three ids fit into one signed 64-bit number
        key = np.zeros(n, np.int64)
        for k in range(width):
            key = key * len(index) + ids[k : k + n]
    else:
        rows = np.stack([ids[k : k + n] for k in range(width)], axis=1)
        key = np.unique(rows, axis=0, return_inverse=True)[1].ravel()
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    hit = np.flatnonzero(counts[inverse] > 1)
    covered = np.zeros(len(words) + 1, np.int32)
    np.add.at(covered, hit, 1)
    np.add.at(covered, hit + width, -1)
    return int((np.cumsum(covered) > 0).sum())


def split_words(text: str, classes: np.ndarray) -> list[str]:
    return _WORD.findall(text) if classes[CLASSES.index("odd_space")] else text.split()


def measure(text: str | None) -> dict:
    """Base figures and the two histograms of one text."""
    text = text or ""
    classes = character_classes(text)
    words = split_words(text, classes)
    seen: set[str] = set()
    duplicates = 0
    for line in text.split("\n"):
        if line in seen:
            duplicates += 1
        elif line.strip(SPACES):
            seen.add(line)
    return {
        "n_words": len(words), "word_chars": len(text) - int(classes[CLASSES.index("space")]), "n_symbols": int(classes[CLASSES.index("symbol")]),
        "n_dup_lines": duplicates, "n_repeat_words": repeated_window_words(words), "classes": classes, "words": words,
    }


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms, each with some mass."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(x > 0, x * np.log2(x / m), 0).sum() for x in (p, q)]
    return float(np.sqrt(max(0.0, sum(parts) / 2)))


def learn_references(docs: DataFrame, text: str = "text", lang: str = "lang", min_words: int = 50, min_share: float = 0.001, min_documents: int = 20) -> dict:
    """Mean histograms of each language over all its documents of ``min_words`` words and more.

    Each such document has the same weight, long or short. A language gets a reference from ``min_documents``
    of these documents on, however small its share of the corpus, or where fewer are ``min_share`` of all.
    """
    n_bins = len(CLASSES) + len(VOCABULARY) + 1

    def histograms(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in portions(batches, "text"):
            for t, code in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if t is None or code is None:
                    continue
                classes = character_classes(t)
                words = Counter((t if not classes[CLASSES.index("odd_space")] else " ".join(_WORD.findall(t))).lower().split())
                if words.total() < min_words:
                    continue
                common = common_words(words)
                row = np.concatenate([classes / classes.sum(), common / common.sum(), [1.0]])
                sums[code] = sums[code] + row if code in sums else row
        yield pa.RecordBatch.from_pydict({"lang": list(sums), "bin": [x.tolist() for x in sums.values()]}, schema=pa.schema([("lang", pa.string()), ("bin", pa.list_(pa.float64()))]))

    partial = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).mapInArrow(lean(histograms), "lang string, bin array<double>")
    summed = partial.groupBy("lang").agg(*[F.sum(F.get("bin", F.lit(i))).alias(f"b{i}") for i in range(n_bins + 1)])
    total = summed.select(F.sum(f"b{n_bins}")).first()[0] or 0.0
    found = summed.where(F.col(f"b{n_bins}") >= min(min_documents, min_share * total)).collect()
    out = {}
    for row in sorted(found, key=lambda r: r["lang"]):
        values = np.array(row[1:], np.float64)
        out[row["lang"]] = {"classes": (values[: len(CLASSES)] / values[-1]).tolist(), "common": (values[len(CLASSES) : -1] / values[-1]).tolist()}
    return out


class Judge:
    """The verdict on a text, with the references and thresholds."""

    def __init__(self, references: dict, max_class: float, max_common: float, min_words: int, min_common_words: int, min_reference: float):
        self.languages = {k: (np.array(v["classes"]), np.array(v["common"])) for k, v in references.items()}
        self.limits = (max_class, max_common, min_words, min_common_words, min_reference)

    def __call__(self, text: str | None, lang: str | None) -> dict:
        max_class, max_common, min_words, min_common, min_reference = self.limits
        out = measure(text)
        words = out.pop("words")
        classes = out.pop("classes")
        failed = out["n_words"] < 50 or 100 * out["n_repeat_words"] > 50 * out["n_words"]
        against = list(self.languages.values()) if lang is None else [self.languages[lang]] if lang in self.languages else []
        by_class = by_common = None
        if against and out["n_words"] >= min_words:
            by_class = min(js_distance(classes, ref) for ref, _ in against)
            usable = [ref for _, ref in against if 1 - ref[-1] >= min_reference]
            if usable and out["n_words"] >= min_common:
                common = common_words(Counter(" ".join(words).lower().split()))
                by_common = min(js_distance(common, ref) for ref in usable)
        diverges = (by_class is not None and by_class > max_class) or (by_common is not None and by_common > max_common)
        return out | {"base_failed": failed, "kept": not (failed or diverges), "class_distance": by_class, "common_distance": by_common}


OUT = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"), ("base_failed", "boolean"), ("kept", "boolean"), ("class_distance", "double"), ("common_distance", "double")]
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}


def quality_rules(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", max_class: float = 0.28, max_common: float = 0.45, min_words: int = 50, min_common_words: int = 100, min_reference: float = 0.1, references: dict | None = None) -> DataFrame:
    """One row per row of ``docs``: its id, the base figures, both distances and the verdict.

    Two passes without a shuffle of texts: the first learns the references (unless given), the second
    judges. ``min_reference`` is the least share of common words that a reference needs for its rule.
    """
    found = learn_references(docs, text, lang, min_words) if references is None else references
    packed = json.dumps(found)

    def judge(batches):
        verdict = Judge(json.loads(packed), max_class, max_common, min_words, min_common_words, min_reference)
        for batch in portions(batches, "text"):
            rows = [verdict(t, code) for t, code in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[name] for r in rows], _ARROW[kind]) for name, kind in OUT]], names=[id, *[name for name, _ in OUT]])

    narrow = docs.select(F.col(id), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    return narrow.mapInArrow(lean(judge), f"`{id}` {docs.schema[id].dataType.simpleString()}, " + ", ".join(f"{name} {kind}" for name, kind in OUT))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the rules keep."""
    text, lang, min_words = options.get("text", "text"), options.get("lang", "lang"), options.get("min_words", 50)
    packed = json.dumps(learn_references(docs, text, lang, min_words))
    limits = tuple(options.get(k, v) for k, v in (("max_class", 0.28), ("max_common", 0.45), ("min_words", 50), ("min_common_words", 100), ("min_reference", 0.1)))

    def keep(batches):
        verdict = Judge(json.loads(packed), *limits)
        for batch in portions(batches, text):
            kept = [verdict(t, code)["kept"] for t, code in zip(batch.column(text).to_pylist(), batch.column(lang).to_pylist(), strict=True)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(lean(keep), docs.schema)
