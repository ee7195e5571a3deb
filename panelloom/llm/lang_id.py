"""Language identification by interpolated Kneser-Ney character models.

Each language has a character model of order four with interpolated Kneser-Ney smoothing. The models
are stored together, order by order: one ascending array of 64-bit n-gram hashes and beside it a matrix
with one column of log probabilities for each language, so that one look-up serves all languages. A
text gets the language with the lowest cross-entropy per character; its score is the calibrated
probability of that language, and a text whose cross-entropy is over what held-back training texts
show is marked as rejected.

The training sample is bounded: some ``per_language`` documents of each language, drawn by a fixed
seed. Every text is then read whole.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; null languages are no
training rows; without any training row every text is ``und``; repeated rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import portions

ORDER = 4
#: Training bounds: languages, documents of each and characters of each document's share in the sample.
MAX_LANGUAGES, PER_LANGUAGE, MAX_SAMPLE_CHARS = 200, 240, 1_200_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_TABLE = 0x3000


def _fold_table() -> np.ndarray:
    """Letters in lower case, all else a space, for code points below ``_TABLE``."""
    out = np.full(_TABLE, 32, np.uint32)
    for i in range(_TABLE):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


_fold = _fold_table()


def fold(text: str) -> np.ndarray:
    """Code points of the letters in lower case, with one space around and between words."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = np.where(codes < _TABLE, _fold[np.minimum(codes, _TABLE - 1)], codes)
    if len(codes) and codes.max() >= _TABLE:
        for c in np.unique(codes[codes >= _TABLE]):
            if not chr(c).isalpha():
                low[low == c] = 32
    low = np.concatenate([np.array([32], np.uint32), low, np.array([32], np.uint32)])
    space = low == 32
    keep = ~(space & np.concatenate([[False], space[:-1]]))
    return low[keep]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _B
    return h ^ (h >> np.uint64(27))


def ngram_hashes(codes: np.ndarray, order: int = ORDER) -> list[np.ndarray]:
    """For n = 1 .. order, the hash of the n characters that end at each place (from place n - 1 on)."""
    single = codes.astype(np.uint64) + np.uint64(1)
    out, h = [], None
    with np.errstate(over="ignore"):
        for n in range(1, order + 1):
            # from the newest character back, so that a shorter n-gram is a prefix of the computation
            part = single[: len(single) - n + 1]
            h = _mix(part * _A) if h is None else _mix((h[1:] ^ (h[1:] << np.uint64(7))) * _A + part)
            out.append(h)
    return out


def _context_hash(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n - 1 characters before each n-gram's last."""
    return ngram_hashes(codes[:-1], n - 1)[n - 2] if n > 1 else np.zeros(len(codes), np.uint64)


class _Counts:
    """Distinct n-grams of one language's sample with what Kneser-Ney needs."""

    def __init__(self, streams: list[np.ndarray], order: int):
        self.grams: list[dict[str, np.ndarray]] = []
        for n in range(1, order + 1):
            key = np.concatenate([ngram_hashes(s, n)[n - 1] for s in streams if len(s) >= n] or [np.zeros(0, np.uint64)])
            context = np.concatenate([_context_hash(s, n) for s in streams if len(s) >= n] or [np.zeros(0, np.uint64)])
            suffix = np.concatenate([ngram_hashes(s[1:], n - 1)[n - 2] for s in streams if len(s) >= n] or [np.zeros(0, np.uint64)]) if n > 1 else None
            u, first, count = np.unique(key, return_index=True, return_counts=True)
            self.grams.append({"key": u, "count": count.astype(np.float64), "context": context[first], "suffix": None if suffix is None else suffix[first]})
        for n in range(order - 1):  # lower orders count the distinct characters before
            upper = self.grams[n + 1]["suffix"]
            u, c = np.unique(upper, return_counts=True)
            at = np.searchsorted(u, self.grams[n]["key"])
            at = np.minimum(at, max(len(u) - 1, 0))
            hit = u[at] == self.grams[n]["key"] if len(u) else np.zeros(len(self.grams[n]["key"]), bool)
            self.grams[n]["count"] = np.where(hit, c[at] if len(u) else 0, 0).astype(np.float64)


def _discount(count: np.ndarray) -> float:
    n1, n2 = float((count == 1).sum()), float((count == 2).sum())
    return n1 / (n1 + 2 * n2) if n1 and n2 else 0.5


class KneserNey:
    """Models of all languages: for each order, sorted hashes with log2 probabilities and back-off weights."""

    def __init__(self, texts: dict[str, list[str]], order: int = ORDER):
        self.order, self.languages = order, sorted(texts)
        counts = [_Counts([fold(t) for t in texts[lang]], order) for lang in self.languages]
        self.keys: list[np.ndarray] = []
        self.logp: list[np.ndarray] = []
        self.context_keys: list[np.ndarray] = []
        self.gamma: list[np.ndarray] = []
        alphabet = max(2, len(np.unique(np.concatenate([c.grams[0]["key"] for c in counts] or [np.zeros(0, np.uint64)]))) + 1)
        self.floor = -np.log2(alphabet)
        lower: list[np.ndarray] = []
        for n in range(1, order + 1):
            keys = np.unique(np.concatenate([c.grams[n - 1]["key"] for c in counts]))
            contexts = np.unique(np.concatenate([c.grams[n - 1]["context"] for c in counts]))
            gamma = np.zeros((len(contexts), len(counts)), np.float32)  # log2; 0 where the context is unknown
            logp = np.zeros((len(keys), len(counts)), np.float32)
            columns = []
            for j, c in enumerate(counts):
                g = c.grams[n - 1]
                d = _discount(g["count"])
                ctx, inverse = np.unique(g["context"], return_inverse=True)
                total = np.bincount(inverse, g["count"], len(ctx))
                kinds = np.bincount(inverse, g["count"] > 0, len(ctx))
                weight = np.where(total > 0, d * kinds / np.maximum(total, 1e-12), 1.0)
                gamma[np.searchsorted(contexts, ctx), j] = np.log2(np.maximum(weight, 1e-12))
                columns.append((g, d, total, inverse))
            # every n-gram of any language gets its interpolated probability in each language
            union_context, union_suffix = self._parents(counts, n, keys)
            self.context_keys.append(contexts)
            self.gamma.append(gamma)
            for j, (g, d, total, inverse) in enumerate(columns):
                own = np.zeros(len(keys))
                own[np.searchsorted(keys, g["key"])] = np.where(total[inverse] > 0, np.maximum(g["count"] - d, 0) / np.maximum(total[inverse], 1e-12), 0)
                below = np.full(len(keys), 1 / alphabet) if n == 1 else 2.0 ** self._lower(lower, n - 1, union_suffix, j)
                at = np.searchsorted(contexts, union_context)
                logp[:, j] = np.log2(own + 2.0 ** gamma[at, j] * below)
            self.keys.append(keys)
            self.logp.append(logp)
            lower.append(logp)
        self._index()
        self.temperature, self.limit = 1.0, float("inf")

    @staticmethod
    def _parents(counts, n, keys):
        context, suffix = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint64)
        for c in counts:
            g = c.grams[n - 1]
            at = np.searchsorted(keys, g["key"])
            context[at] = g["context"]
            if n > 1:
                suffix[at] = g["suffix"]
        return context, suffix

    def _lower(self, lower, n, suffix, j):
        at = np.searchsorted(self.keys[n - 1], suffix)
        return lower[n - 1][at, j]

    def _index(self) -> None:
        """Where the hashes with each top bits begin: hashes are even, so a few steps find one."""
        self.starts = []
        for keys in (*self.keys, *self.context_keys):
            bits = max(1, int(np.log2(max(2, len(keys)))))
            shift = np.uint64(64 - bits)
            self.starts.append((shift, np.searchsorted(keys >> shift, np.arange(2**bits + 1, dtype=np.uint64)).astype(np.int32)))

    def _find(self, which: int, keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Place of each wanted hash, or -1."""
        shift, starts = self.starts[which]
        if not len(keys):
            return np.full(len(wanted), -1)
        top = (wanted >> shift).astype(np.int64)
        at, end = starts[top].copy(), starts[top + 1]
        out = np.full(len(wanted), -1, np.int64)
        active = np.flatnonzero(at < end)
        while len(active):
            here = at[active]
            hit = keys[here] == wanted[active]
            out[active[hit]] = here[hit]
            at[active] += 1
            active = active[~hit & (here + 1 < end[active]) & (keys[here] < wanted[active])]
        return out

    def entropies(self, streams: list[np.ndarray]) -> np.ndarray:
        """Cross-entropy per character of each folded text in each language."""
        if not streams:
            return np.zeros((0, len(self.languages)))
        codes = np.concatenate(streams)
        sizes = np.array([len(s) for s in streams])
        ends = np.cumsum(sizes)
        place = np.arange(len(codes)) - np.repeat(ends - sizes, sizes)  # within its own text
        hashes = ngram_hashes(codes, self.order)
        total = np.full((len(codes), len(self.languages)), self.floor, np.float32)
        open_ = np.arange(len(codes))
        back = np.zeros((len(codes), len(self.languages)), np.float32)
        for n in range(self.order, 0, -1):
            if n < self.order or n > 1:
                fits = place[open_] >= n - 1
            else:
                fits = np.ones(len(open_), bool)
            tried = open_[fits]
            found = self._find(n - 1, self.keys[n - 1], hashes[n - 1][tried - (n - 1)])
            hit = found >= 0
            total[tried[hit]] = self.logp[n - 1][found[hit]] + back[tried[hit]]
            missed = tried[~hit]
            if n > 1 and len(missed):
                context = hashes[n - 2][missed - 1 - (n - 2)]
                at = self._find(self.order + n - 1, self.context_keys[n - 1], context)
                back[missed[at >= 0]] += self.gamma[n - 1][at[at >= 0]]
            open_ = np.concatenate([open_[~fits], missed]) if n > 1 else missed
        total[open_] = self.floor + back[open_] + self.gamma[0][0]  # the weight that the characters seen leave over
        return -np.add.reduceat(total, ends - sizes, axis=0).astype(np.float64) / sizes[:, None]

    def calibrate(self, texts: dict[str, list[str]], quantile: float = 0.999, slack: float = 1.15) -> None:
        """Temperature of the score, and the cross-entropy over which a text is rejected, from texts held back."""
        streams = [(fold(t), self.languages.index(lang)) for lang in texts if lang in self.languages for t in texts[lang]]
        streams = [s for s in streams if len(s[0]) > 2]
        if not streams:
            return
        truth = np.array([s[1] for s in streams])
        h = self.entropies([s[0] for s in streams])
        best = (np.inf, 1.0)
        for t in (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8, 1.2):
            z = -(h - h.min(axis=1, keepdims=True)) / t
            loss = float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(truth)), truth]))
            best = min(best, (loss, t))
        self.temperature = best[1]
        self.limit = float(np.quantile(h.min(axis=1), quantile) * slack)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float | None, bool]]:
        """(language, score, cross-entropy, rejected) of each text."""
        out: list = [("und", 0.0, None, True)] * len(texts)
        if not self.languages:
            return out
        streams = [(i, s) for i, t in enumerate(texts) if t and len(s := fold(t)) > 1 and (s != 32).any()]
        h = self.entropies([s for _, s in streams])
        for (i, _), row in zip(streams, h, strict=True):
            j = int(np.argmin(row))
            score = 1.0 / float(np.exp(-(row - row[j]) / self.temperature).sum())
            out[i] = (self.languages[j], score, float(row[j]), bool(row[j] > self.limit))
        return out


def sample(labelled: DataFrame, text: str, lang: str, per_language: int) -> dict[str, list[str]]:
    """A bounded sample for the driver: of each language some ``per_language`` texts, drawn by a fixed seed.

    At most ``MAX_LANGUAGES`` languages, those with most rows. The counts of rows are taken over all rows.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return {}
    drawn = rows.sampleBy("lang", {r["lang"]: min(1.0, 1.3 * per_language / r["n"]) for r in counts}, 11)
    drawn = drawn.where(F.length("text") <= MAX_SAMPLE_CHARS // 8).withColumn("h", F.xxhash64("text"))
    top = drawn.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("n") <= per_language)
    out: dict[str, list[str]] = {}
    for r in sorted(top.collect(), key=lambda r: (r["lang"], r["n"])):
        own = out.setdefault(r["lang"], [])
        if sum(map(len, own)) < MAX_SAMPLE_CHARS:
            own.append(r["text"])
    return out


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> KneserNey:
    """Models of the languages in ``labelled``; a fifth of the sample is held back for the calibration."""
    found = sample(labelled, text, lang, per_language)
    model = KneserNey({k: [t for i, t in enumerate(v) if i % 5 or len(v) < 5] for k, v in found.items()}) if found else _empty()
    model.calibrate({k: [t for i, t in enumerate(v) if not i % 5] for k, v in found.items()})
    return model


def _empty() -> KneserNey:
    model = KneserNey.__new__(KneserNey)
    model.languages, model.order, model.temperature, model.limit = [], ORDER, 1.0, float("inf")
    model.keys = model.logp = model.context_keys = model.gamma = model.starts = []
    return model


def identify(docs: DataFrame, model: KneserNey, id: str = "doc_id", text: str = "text", keep: Iterable[str] = ()) -> DataFrame:
    """One row per row of ``docs``: id, the columns in ``keep``, lang_pred, score, cross_entropy, rejected."""
    keep = list(keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in portions(batches, "text", 1_000_000):
            found = shared.value.predict(batch.column(0).to_pylist())
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], names=[id, *keep, "lang_pred", "score", "cross_entropy", "rejected"])

    narrow = docs.select(F.col(text).cast("string").alias("text"), F.col(id), *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[1:])
    return narrow.mapInArrow(run, f"{schema}, lang_pred string, score double, cross_entropy double, rejected boolean")
