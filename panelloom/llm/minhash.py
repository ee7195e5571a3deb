"""Near-duplicates by DartMinHash signatures, a banded join and an exact check.

A document is a weighted set: its shingles of five words, each weighing as often as it occurs. Darts are
thrown, by hashing, at the plane of weight and rank above each element: a unit of weight gets a Poisson
number of darts in each dyadic cell of rank, and every dart falls on one of ``K`` coordinates. The earliest
dart of a coordinate is the signature there, so only about ``K ln K`` darts of a document are ever looked
at. Two documents agree on a coordinate as often as their weighted Jaccard similarity says.

Signatures are cut into bands. In each bucket of equal bands one document takes the lead, the one that
shares most buckets with others, and is checked exactly against the bucket's other documents. It then
leaves; while the rest has two classes or more, the next one leads. So no link between different texts
in a bucket is lost, and no bucket's pairs are listed. What is left after ``lead_rounds`` rounds, documents
of hot buckets that are much like each other without being similar, is met at rare elements: those in which
it differs from the bucket's first lead (a prefix join, which loses no pair either). Bounds drop pairs
that cannot be similar: elements that no other candidate has are shared with none, and what two
documents share of the bucket's first lead is bounded by what each shares with it. With 32 bands of 5, a pair at similarity
0.8 shares no bucket with a probability below 4e-6. The classes are the connected components.

Equal texts are one document until the end; they are joined by their hash and never compared.

Defined cases: a text of fewer than five words is one shingle; a text without a word (null, empty, white
space) is a class of its own, though exact copies of a non-empty text are one class; repeated rows give
repeated rows in the result; a null id is a row of its own class; ids are numbers, or texts of numbers (others
end the job with Spark's cast error); columns of any name may stand beside; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import files_for, lean, materialize, portions, unused

SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 32, 5
K = BANDS * ROWS
_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
CACHE_WORDS = 200_000
#: Row groups of the tables of elements: few long texts may hold most elements, and readers split at these.
ELEMENT_GROUP = 4_000_000
#: Steps of size for each factor 1/similarity in the bounds on partners.
SIZE_STEPS = 2


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _C2
    h = (h ^ (h >> np.uint64(27))) * _C3
    return h ^ (h >> np.uint64(31))


class _Words(dict):
    """64-bit hashes of words, made when first asked for."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            for old in list(islice(self, CACHE_WORDS // 3, None)):
                del self[old]
        out = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return out


_words = _Words()


def forget_words() -> None:
    """For functions that go to workers by value: these would clear a copy of ``_words`` of their own."""
    _words.clear()


def elements(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Elements of all texts in a row, and how many each text has.

    An element is a shingle with the number of its occurrence, so that the set of elements is the
    weighted set of shingles: a shingle that occurs three times is three elements of weight one.
    """
    words = [t.lower().split() if t else [] for t in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter(map(_words.__getitem__, chain.from_iterable(words)), np.uint64, int(n_words.sum()))
    begins = np.cumsum(n_words) - n_words
    count = np.where(n_words == 0, 0, np.maximum(n_words - SHINGLE + 1, 1))
    owner = np.repeat(np.arange(len(texts)), count)
    if not len(owner):
        return np.zeros(0, np.uint64), count
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    at = begins[owner] + offset
    h = np.zeros(len(owner), np.uint64)
    padded = np.concatenate([flat, np.zeros(SHINGLE, np.uint64)])
    with np.errstate(over="ignore"):
        for k in range(SHINGLE):
            inside = offset + k < n_words[owner]
            h = mix(h * _C1 + np.where(inside, padded[at + k], np.uint64(k + 1)))
    # number equal shingles of one text by occurrence
    by_text = mix(h ^ (owner.astype(np.uint64) * _C2))
    order = np.argsort(by_text, kind="stable")
    run = np.concatenate([[True], by_text[order][1:] != by_text[order][:-1]])
    start = np.maximum.accumulate(np.where(run, np.arange(len(order)), 0))
    nth = np.empty(len(order), np.uint64)
    nth[order] = (np.arange(len(order)) - start).astype(np.uint64)
    with np.errstate(over="ignore"):
        return np.where(nth > 0, mix(h + nth * _C1), h), count


@lru_cache
def _poisson_steps(mean: float) -> np.ndarray:
    """Cumulative distribution, to turn a uniform number into a count."""
    return np.cumsum(np.exp(-mean) * np.cumprod(np.concatenate([[1.0], mean / np.arange(1, 8 * mean + 24)])))


def _cell(number: int) -> tuple[float, float]:
    """Lowest rank and width of a cell: widths double up to 32 and then stay."""
    return (2.0**number - 1, 2.0**number) if number < 5 else (31.0 + 32 * (number - 5), 32.0)


def signatures(element: np.ndarray, count: np.ndarray, k: int = K) -> np.ndarray:
    """Signature of each text with elements (those with ``count`` > 0), as hashes of the earliest darts."""
    texts = np.flatnonzero(count)
    out = np.zeros((len(texts), k), np.uint64)
    size = count[texts].astype(np.float64)
    ends = np.cumsum(count[texts])
    todo, theta = np.arange(len(texts)), 1.0
    while len(todo):
        limit = theta * (k * np.log(k) + 2 * k) / size[todo]  # ranks that give some k ln k + 2 k darts
        keep_rank = np.full((len(todo), k), np.inf)
        own = np.concatenate([np.arange(ends[i] - count[texts[i]], ends[i]) for i in todo]) if len(todo) < len(texts) else np.arange(len(element))
        who = np.repeat(np.arange(len(todo)), count[texts[todo]])
        cell = 0
        while True:
            low, width = _cell(cell)
            open_ = limit[who] > low
            if not open_.any():
                break
            e, w = element[own[open_]], who[open_]
            _throw(e, w, cell, low, width, limit, keep_rank, out, todo, k)
            cell += 1
        full = np.isfinite(keep_rank).all(axis=1)
        todo, theta = todo[~full], theta * 2
    return out


def _throw(e, w, cell, low, width, limit, keep_rank, out, todo, k):
    """Darts of one cell of rank above each element; the earliest of each coordinate stays."""
    with np.errstate(over="ignore"):
        seed = mix(e + np.uint64(cell + 1) * _C1)
        n = np.searchsorted(_poisson_steps(width), (seed >> np.uint64(11)).astype(np.float64) * 2.0**-53)
        hit = np.flatnonzero(n)
        n = n[hit]
        source = np.repeat(hit, n)
        nth = np.arange(len(source)) - np.repeat(np.cumsum(n) - n, n)
        dart = mix(seed[source] ^ mix((nth.astype(np.uint64) + np.uint64(1)) * _C3))
        rank = low + width * ((dart >> np.uint64(11)).astype(np.float64) * 2.0**-53)
        inside = rank < limit[w[source]]
        dart, rank, text = dart[inside], rank[inside], w[source[inside]]
        dart = mix(dart + _C1)
        place = text * k + (dart % np.uint64(k)).astype(np.int64)
    order = np.argsort(-rank, kind="stable")
    best = np.full(keep_rank.size, -1, np.int64)
    best[place[order]] = order  # the last one written, the smallest rank, stays
    filled = np.flatnonzero(best >= 0)
    better = rank[best[filled]] < keep_rank.ravel()[filled]
    filled = filled[better]
    keep_rank.ravel()[filled] = rank[best[filled]]
    out[todo[filled // k], filled % k] = dart[best[filled]]


def band_hashes(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One signed 64-bit hash for each band of each signature."""
    parts = sig.reshape(len(sig), bands, sig.shape[1] // bands)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands)) * _C1
    with np.errstate(over="ignore"):
        for r in range(parts.shape[2]):
            h = mix(h * _C1 + parts[:, :, r])
    return h.astype(np.int64)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


def bands_of(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, key, bands) of each row: key is a hash of the text; bands is null for a text without a word."""

    def run(batches):
        for batch in portions(batches, "text", 1_000_000, 2_000):
            texts = batch.column(2).to_pylist()
            element, count = elements(texts)
            bands = band_hashes(signatures(element, count))
            has = count > 0
            sizes = np.where(has, BANDS, 0)
            lists = _lists(bands.ravel(), sizes)
            lists = pa.ListArray.from_buffers(lists.type, len(lists), [pa.array(has).buffers()[1], lists.buffers()[1]], children=[lists.values]) if not has.all() else lists
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["id", "key", "bands"])
        forget_words()  # the worker may serve other operators next

    t = F.col(text).cast("string")
    return docs.select(F.col(id).cast("long").alias("id"), F.md5(t).alias("key"), t.alias("text")).mapInArrow(lean(run), "id long, key string, bands array<long>")


def elements_of(docs: DataFrame) -> DataFrame:
    """(id, elements) of (id, text) rows; elements are ascending."""

    def run(batches):
        for batch in portions(batches, "text", 1_000_000, 2_000):
            element, count = elements(batch.column(1).to_pylist())
            owner = np.repeat(np.arange(len(count)), count)
            signed = element.astype(np.int64)
            order = np.lexsort((signed, owner))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(signed[order], count)], names=["id", "elements"])
        forget_words()

    return docs.select("id", "text").mapInArrow(lean(run), "id long, elements array<long>")


def components(labels: DataFrame, edges: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """(id, label): the smallest id of each node's component by the (a, b) ``edges``, from labels so far.

    Labels move along edges, and what a label's own node or another node with that label has found,
    all take over that have it; so a chain of n edges takes about log n rounds. Each round is written
    to the shared folder; nothing but a flag reaches the driver.
    """
    both = materialize(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))), f"{name}-edges", files)
    while True:
        near = both.join(labels.select(F.col("id").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        moved = materialize(labels.join(near.withColumnRenamed("u", "id"), "id", "left").select("id", "label", F.least("label", F.coalesce("near", "label")).alias("new")), f"{name}-moved", files)
        if moved.where("new < label").isEmpty():
            return labels
        told = moved.select("label", "new").unionByName(moved.select(F.col("id").alias("label"), "new")).groupBy("label").agg(F.min("new").alias("told"))
        labels = materialize(moved.join(told, "label").select("id", F.least("new", "told").alias("label")), f"{name}-labels", files)


def overlaps(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """(a, b, shared, total): how many elements the documents of each pair share, and how many they have in all."""
    left = pairs.join(own.select(F.col("id").alias("a"), F.col("elements").alias("ea")), "a")
    both = left.join(own.select(F.col("id").alias("b"), F.col("elements").alias("eb")), "b")
    return both.select("a", "b", F.size(F.array_intersect("ea", "eb")).cast("long").alias("shared"), (F.size("ea") + F.size("eb")).cast("long").alias("total"))


def extents(own: DataFrame) -> DataFrame:
    """(id, size, common) of (id, elements) rows, each id once: all elements, and those that another row has, too."""
    alone = own.select("id", F.explode("elements").alias("e")).groupBy("e").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).where("n = 1").groupBy("id").agg(F.count(F.lit(1)).alias("alone"))
    sizes = own.select("id", F.size("elements").cast("long").alias("size"))
    return sizes.join(alone, "id", "left").select("id", "size", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("common"))


def may_reach(similarity: float, one: str, two: str) -> Column:
    """Whether two rows that have met one pivot can be similar: a bound on what they share that loses no pair.

    They share no more than either has in common with any document, no more of the pivot than the one with
    less of it has, and no more besides than either has in common with others outside of it.
    """
    at = lambda t, c: F.col(f"{t}.{c}")
    most = F.least(at(one, "common"), at(two, "common"))
    beside = F.least(at(one, "common") - at(one, "pivot"), at(two, "common") - at(two, "pivot"))
    most = F.least(most, F.least(at(one, "pivot"), at(two, "pivot")) + F.greatest(beside, F.lit(0)))
    return most >= similarity * (at(one, "size") + at(two, "size") - most) - 1e-9


def partners_by_size(met: DataFrame, similarity: float) -> DataFrame:
    """``met`` with bounds over the rows of its pivot whose sizes allow similarity, those ``outside`` (out_) and the others (in_).

    The bounds are the most that such a row has in common with any, shares with the pivot, has in common besides and has of the
    pivot over its part of a similar pair (over), the highest likeness and the least size. They are NULL where there is no such
    row. Sizes are told in ``SIZE_STEPS`` steps for each factor 1/similarity, so a row's partners are at most that many steps away.
    """
    part = similarity / (1 + similarity)
    step = math.log(1 / similarity) / SIZE_STEPS + 1e-6  # a little wider, so that rounding puts no partner a step too far
    met = met.withColumn("step", F.floor(F.log("size") / step))
    best = {"common": F.max("common"), "pivot": F.max("pivot"), "beside": F.max("beside"), "alike": F.max("alike"), "over": F.max(F.col("pivot") - part * F.col("size")), "size": F.min("size")}
    own = met.groupBy("pivot_id", "outside", "step").agg(*[how.alias(c) for c, how in best.items()])
    around = own.withColumn("step", F.explode(F.sequence(F.col("step") - SIZE_STEPS, F.col("step") + SIZE_STEPS)))
    sides = {"out": F.col("outside"), "in": ~F.col("outside")}
    bounds = [(F.min if c == "size" else F.max)(F.when(of, F.col(c))).alias(f"{side}_{c}") for side, of in sides.items() for c in best]
    return met.join(around.groupBy("pivot_id", "step").agg(*bounds), ["pivot_id", "step"]).drop("step")


def prefix_pairs(rows: DataFrame, own: DataFrame, labels: DataFrame, similarity: float, files: int | None = None) -> DataFrame:
    """(a, b) of all rows with one pivot, but of different labels, that can be similar, met at rare elements. None is lost.

    ``rows`` are (rep, size, common, label, pivot, pivot_id): the row shares ``pivot`` elements with the document
    ``pivot_id``, and has that one's label where they are similar. Two sets that must share t elements share one
    of the |set| - t + 1 that are rarest; so a pair is met there, and never because both are in a hot group.

    Rows much like their pivot P are compared by what they differ in from it: what they lack of it and what
    they have besides. Two rows share |a in P| + |b in P| - |P| elements plus the differences they share, so
    those that are similar must share many; and at most one of the two is similar to P itself. The rows of a
    like size (``partners_by_size``) say how many at least, and rows without a possible partner go before
    their elements are told. By the triangle inequality of Jaccard distances the partner of a row that is unlike P
    (under 0.5) is not very similar to it either; such pairs are compared by their own elements.
    """
    part = similarity / (1 + similarity)  # of both sizes, what a similar pair shares
    reps = rows.select("rep", "size", "common", "label", "pivot", "pivot_id").distinct()
    heads = reps.select(F.col("pivot_id").alias("id")).distinct().join(own, "id").join(labels, "id").select(F.col("id").alias("pivot_id"), F.size("elements").alias("n_head"), F.col("label").alias("head_label"))
    alike = F.col("pivot") / (F.col("size") + F.col("n_head") - F.col("pivot"))
    met = reps.join(heads, "pivot_id").withColumns({"alike": alike, "outside": F.col("label") != F.col("head_label")}).drop("head_label")
    met = met.withColumn("beside", F.greatest(F.col("common") - F.col("pivot"), F.lit(0)))
    sized = partners_by_size(met.where("alike >= 0.5"), similarity)
    sharable = F.col("n_head") - F.col("pivot") + F.col("beside")  # what a row lacks of P others may lack, too
    near = sized.withColumns({"by": F.lit(0), "far": F.lit(False), "n_set": F.col("size") + F.col("n_head") - 2 * F.col("pivot")})
    # the least number of differences that a row shares with a similar row outside, or inside, if such a row may be
    least = {}
    for side in ("out", "in"):
        most = F.least("common", f"{side}_common", F.least("pivot", f"{side}_pivot") + F.least("beside", f"{side}_beside"))
        reaches = most >= part * (F.col("size") + F.greatest(F.col(f"{side}_size"), similarity * F.col("size"))) - 1e-9
        shares = F.greatest(F.ceil(part * F.col("size") - F.col("pivot") + F.col("n_head") - F.col(f"{side}_over") - 1e-9), F.lit(1))
        least[side] = F.when(F.col(f"{side}_size").isNotNull() & reaches & (shares <= sharable), shares).otherwise(F.col("n_set") + 1)
    near = near.withColumns({"need": least["out"], "any_need": F.when(F.col("outside"), least["in"]).otherwise(least["out"])})
    near = near.where(F.least("need", "any_need") <= F.col("n_set")).select(*met.columns, "by", "far", "n_set", "need", "any_need")
    own_need = F.ceil(similarity * F.col("size") - 1e-9)
    # rows less alike only matter where some row of a like size is unlike
    unlike = partners_by_size(met.where(F.col("alike") <= 1.5 - similarity + 1e-9).withColumn("outside", F.col("alike") < 0.5), similarity)
    reaches = F.least("common", "out_common") >= part * (F.col("size") + F.greatest("out_size", similarity * F.col("size"))) - 1e-9
    plain = unlike.where((F.col("alike") <= F.col("out_alike") + 1 - similarity + 1e-9) & reaches).select(*met.columns)
    plain = plain.withColumns({"by": F.lit(1), "far": F.col("alike") < 0.5, "outside": F.lit(True), "n_set": F.col("size"), "need": own_need, "any_need": own_need})
    both = near.unionByName(plain)
    mixed = both.groupBy("pivot_id", "by").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("pivot_id", "by")
    both = both.join(mixed, ["pivot_id", "by"], "left_semi").join(own.select(F.col("id").alias("rep"), "elements"), "rep").join(own.select(F.col("id").alias("pivot_id"), F.col("elements").alias("head")), "pivot_id")
    differ = F.concat(F.array_except("elements", "head"), F.transform(F.array_except("head", "elements"), lambda e: F.bitwise_not(e)))
    sets = both.withColumn("set", F.when(F.col("by") == 0, differ).otherwise(F.col("elements"))).drop("elements", "head", "alike", "n_head", "beside")
    held = materialize(sets.where(F.least("need", "any_need") <= F.col("n_set")).withColumn("e", F.explode("set")).drop("set"), "minhash-held", files, ELEMENT_GROUP)
    group = ["pivot_id", "by"]
    # rows of one label are never compared, so an element that only such rows have (one row, say) meets nobody
    holders = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("rep")).alias("who"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("mark"), F.min("label").alias("low"), F.max("label").alias("high")]
    mixed_elements = held.groupBy(*group, "e").agg(*holders).where("low < high")
    # elements that the same rows have, those of a passage say, are as good as one: it is looked up for all ``m`` of them
    alike_held = mixed_elements.groupBy(*group, "n", "who", "mark").agg(F.min("e").alias("e"), F.count(F.lit(1)).alias("m"))
    row = Window.partitionBy(*group, "rep")
    up_to = F.sum("m").over(row.orderBy("n", "who", "mark").rowsBetween(Window.unboundedPreceding, 0))
    # ``place`` is that of the first of the ``m``; elements that meet nobody come first in each row's order
    ranked = held.join(alike_held, [*group, "e"]).withColumn("place", F.col("n_set") - F.sum("m").over(row) + up_to - F.col("m") + 1)
    first = ranked.where(F.col("place") <= F.col("n_set") - F.least("need", "any_need") + 1).withColumn("early", F.col("place") <= F.col("n_set") - F.col("need") + 1)
    first = materialize(first.select(*reps.columns, "by", "who", "outside", "far", "early"), "minhash-prefixes", files)
    one, two = first.alias("one"), first.alias("two")
    at = lambda c: (F.col(f"one.{c}"), F.col(f"two.{c}"))
    equal = (F.col("one.pivot_id") == F.col("two.pivot_id")) & (F.col("one.by") == F.col("two.by")) & (F.col("one.who") == F.col("two.who"))
    fits = (F.col("one.rep") < F.col("two.rep")) & (F.col("one.label") != F.col("two.label")) & (F.least(*at("size")) >= similarity * F.greatest(*at("size")) - 1e-9)
    # a row similar to the pivot looks for rows outside at its early elements, and those for it at all they have here
    places = F.when(F.col("one.outside") & F.col("two.outside"), F.col("one.early") & F.col("two.early")).otherwise(F.when(F.col("one.outside"), F.col("two.early")).otherwise(F.col("one.early")))
    of_scheme = (F.col("one.by") == 0) | F.col("one.far") | F.col("two.far")
    pairs = one.join(two, equal & fits & places & of_scheme & may_reach(similarity, "one", "two"))
    return pairs.select(F.col("one.rep").alias("a"), F.col("two.rep").alias("b"))


def classified(docs: DataFrame, id: str, text: str, similarity: float, lead_rounds: int) -> DataFrame:
    """(id, key, label, class_id) of each row of ``docs``: hash of the text, what its class alone has (NULL: no class), the class's smallest id."""
    spark = docs.sparkSession
    narrow = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    total = docs.count()
    cores = spark.sparkContext.defaultParallelism
    # tables of texts and elements, of pairs to be checked, and small ones of labels and bounds
    many, files, few = files_for(spark, total, 16_000), files_for(spark, total, 100_000, cores), files_for(spark, total, 100_000, 2)
    signed = materialize(bands_of(narrow, "id", "text"), "minhash-bands", many)
    known = signed.where(F.col("id").isNotNull() & F.col("bands").isNotNull())
    # one document stands for equal texts; their bands are equal, too
    copies = materialize(known.groupBy("key").agg(F.min("id").alias("first"), F.any_value("bands").alias("bands")), "minhash-reps", files)
    # an id with several texts is no name for any of them; elsewhere the id stands for the text
    again = copies.groupBy("first").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    reused = not again.isEmpty()
    copies = copies.join(again, "first", "left").withColumn("rep", F.when(F.col("texts").isNull(), F.col("first")).otherwise(F.xxhash64("first", "key"))) if reused else copies.withColumn("rep", F.col("first"))
    buckets = copies.select("rep", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = materialize(buckets.join(shared, "bucket").select("bucket", "rep", "n"), "minhash-buckets", files)
    # the copy that the others were made from shares more and larger buckets than they do with each other
    scores = materialize(met.groupBy("rep").agg(F.sum("n").alias("score")), "minhash-nodes", few)
    nodes = scores.select(F.col("rep").alias("id"))
    if reused:
        named = copies.join(nodes.withColumnRenamed("id", "rep"), "rep").select(F.col("first").alias("id"), "key", "rep")
        texts = narrow.withColumn("key", F.md5("text")).join(named, ["id", "key"]).select(F.col("rep").alias("id"), "text")
    else:
        texts = narrow.join(nodes, "id", "left_semi")
    held = elements_of(texts)
    if not signed.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():  # repeated rows: one stands for them
        held = held.where(F.size("elements") > 0).dropDuplicates(["id"])
    own = materialize(held, "minhash-elements", many, ELEMENT_GROUP)
    labels, edges, turn = nodes.select("id", F.col("id").alias("label")), None, 0
    rows = met.join(scores, "rep").select("bucket", "rep", "score", F.col("rep").alias("label"), *[F.lit(None).cast("long").alias(c) for c in ("size", "common", "pivot", "pivot_id")])
    kept = ["bucket", "rep", "score", "size", "common", "pivot", "pivot_id"]
    while True:
        turn += 1
        lead = F.max(F.struct("score", (-F.col("rep")).alias("rep"), "label", "size", "common", "pivot")).alias("lead")
        first = rows.groupBy("bucket").agg(lead, F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        rows = materialize(rows.join(first.select("bucket", "lead"), "bucket"), "minhash-open", few)
        if rows.isEmpty():
            break
        to_lead = rows.where(F.col("rep") != -F.col("lead.rep")).withColumns({"a": F.least("rep", -F.col("lead.rep")), "b": F.greatest("rep", -F.col("lead.rep"))})
        if turn == 1:  # the first lead meets its whole bucket and is its pivot from then on
            pairs = to_lead.select("a", "b")
        elif turn <= lead_rounds:
            pairs = to_lead.alias("row").where((F.col("label") != F.col("lead.label")) & may_reach(similarity, "row", "row.lead")).select("a", "b")
        else:  # what no lead resolves: pairs of one bucket's pivot and different classes that share rare differences
            pairs = prefix_pairs(rows, own, labels, similarity, few)
        seen = materialize(overlaps(pairs.distinct(), own), "minhash-overlaps", files)
        found = seen.where(F.col("shared") >= similarity * (F.col("total") - F.col("shared"))).select("a", "b")
        edges = found if edges is None else edges.unionByName(found)
        if not found.isEmpty():
            labels = components(labels, edges, "minhash", few)
        if turn > lead_rounds:
            break
        # leads have met their bucket and leave it; the rest matters while it has two classes or more
        if turn == 1:
            to_lead = to_lead.drop("pivot", "pivot_id").join(seen.select("a", "b", F.col("shared").alias("pivot")), ["a", "b"]).withColumn("pivot_id", -F.col("lead.rep"))
        rows = to_lead.select(*kept).join(labels.withColumnRenamed("id", "rep"), "rep")
        if turn == 1:
            mixed = rows.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("bucket")
            rows = materialize(rows.drop("size", "common").join(mixed, "bucket", "left_semi"), "minhash-rest", files)
            open_ = rows.select(F.col("rep").alias("id")).unionByName(rows.select(F.col("pivot_id").alias("id"))).distinct()
            stats = materialize(extents(own.join(open_, "id", "left_semi")).withColumnRenamed("id", "rep"), "minhash-extents", many)
            rows = rows.join(stats, "rep").where(F.col("common") >= similarity * F.col("size") - 1e-9)
    of_rep = copies.select("key", "first", "rep").join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("key", "first", F.coalesce("label", "rep").alias("label"))
    if reused:
        of_rep = of_rep.join(of_rep.groupBy("label").agg(F.min("first").alias("class_id")), "label")
    else:
        of_rep = of_rep.withColumn("class_id", F.col("label"))
    has = F.col("bands").isNotNull() & F.col("id").isNotNull()
    classed = signed.select("id", "key", has.alias("has")).join(of_rep.select("key", "label", "class_id"), "key", "left")
    return classed.select("id", "key", F.when(F.col("has"), F.col("label")).alias("label"), F.when(F.col("has"), F.col("class_id")).otherwise(F.col("id")).alias("class_id")).coalesce(many)


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, lead_rounds: int = 3) -> DataFrame:
    """(id, class_id) of each row of ``docs``: class_id is the smallest id of its near-duplicates' class."""
    return classified(docs, id, text, similarity, lead_rounds).select(F.col("id").alias(id), "class_id")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their class; of rows with equal ids and texts, one.

    Of the texts of a class under its smallest id, the one with the smallest hash stays. Rows with a null id all stay.
    """
    rows = classified(docs, id, text, similarity, 3).where("id is not null")
    first = rows.where("label is not null").groupBy("label").agg(F.min(F.struct("id", "key")).alias("at")).select("at.id", "at.key")
    own_id, own_key, turn = (unused(docs, c) for c in ("id", "key", "turn"))
    kept = first.union(rows.where("label is null").select("id", "key").distinct()).select(F.col("id").alias(own_id), F.coalesce("key", F.lit("")).alias(own_key))
    key = F.coalesce(F.md5(F.col(text).cast("string")), F.lit(""))
    out = docs.join(kept, (docs[id].cast("long") == F.col(own_id)) & (key == F.col(own_key)), "left_semi")
    if not rows.groupBy("id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        order = F.xxhash64(*[f"`{name}`" for name, kind in docs.dtypes if "map<" not in kind])
        out = out.withColumn(turn, F.row_number().over(Window.partitionBy(F.col(id).cast("long"), key).orderBy(order))).where(F.col(turn) == 1).drop(turn)
    return out.unionByName(docs.where(F.col(id).cast("long").isNull()))
