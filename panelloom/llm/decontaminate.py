"""Benchmark decontamination with SimHash windows, by DataFrame functions only.

1. Texts become words (letters and digits, lower case) and their shingles of five words, as hashes. A
   shingle weighs the more, the fewer items have it. The *telling* shingles of an item are its heaviest:
   a window with none of them cannot hold ``similarity`` of the item's weight.
2. A bit map over the telling shingles finds the documents in question without a shuffle of texts; shingles
   that many items share (licenses, templates) tell nothing and let no document through.
3. Windows as long as the item are laid over these documents, wherever one of the item's shingles stands,
   so that it stands where the item has it.
4. Each distinct window and each item gets a SimHash of 64 bits over its weighted shingles.
5. Fingerprints are cut into four blocks of 16 bits. Two fingerprints within a Hamming distance of
   ``4 e + 3`` have a block in which they differ in ``e`` bits at most, so the items are listed under every
   value of each block that is at most ``e`` bits away, and an equi-join of blocks finds all pairs within the
   radius; of unrelated pairs, 4 % meet in a block. Fingerprints may lie further apart where a window
   has lost some of the item, so windows also meet the items of whose telling shingles they hold one. No
   pair is lost.
6. A candidate counts when the window holds ``similarity`` of the item's weighted shingles.

Defined cases: null and empty texts and items match nothing, as do items of fewer than five words; a
document shorter than an item is one window; equal items (in words) are one item until the end and are
reported under each of their ids, a null id among them; of several texts under one id the most similar one
is told; repeated documents are reported once for each id; other columns are not read. ``remove_leaks``
goes by rows: of several texts under one id, or under none, only those that hold an item go.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import files_for, materialize, unused

SHINGLE, SIMILARITY, RADIUS, BLOCKS, BLOCK_BITS = 5, 0.8, 15, 4, 16
#: The bit map has 2 ** bits bits, at least MAP_ROOM for each shingle and within these limits.
LEAST_BITS, MOST_BITS, MAP_ROOM = 20, 25, 128


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def word_hashes(text: Column) -> Column:
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def let(make: Callable[[Column], Column], value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(make(value))`` with both steps computed once, however often ``make`` and ``body`` use them.

    Both are bound as variables of a lambda: the optimizer would otherwise put their expressions in
    place of each use, even inside the loops of other lambdas.
    """
    made = F.get(F.transform(F.array(value), make), 0)
    return F.get(F.transform(F.array(made), body), 0)


def shingles(hashes: Column) -> Column:
    """Hashes of the windows of five, from an array of word hashes (empty where there are fewer)."""
    last = F.size(hashes) - SHINGLE
    each = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(SHINGLE)]))
    return F.when(last >= 0, each).otherwise(F.array().cast("array<bigint>"))


def _positions(h: Column, bits: int) -> list[Column]:
    mask = F.lit((1 << bits) - 1)
    return [F.shiftrightunsigned(h, shift).bitwiseAND(mask).cast("int") for shift in (0, 19, 38)]


class ShingleMap:
    """A bit map over shingles (h), with three bits for each.

    Of ``MAP_ROOM`` bits a shingle, one foreign shingle in 70,000 seems known. The map is a literal of
    the plan, 4 MB at most; a benchmark that outgrows it lets more documents pass on to the exact steps.
    """

    def __init__(self, shingles: DataFrame):
        known = shingles.select("h").distinct()
        self.bits = min(MOST_BITS, max(LEAST_BITS, (MAP_ROOM * known.count()).bit_length()))
        at = known.select(F.explode(F.array(*_positions(F.col("h"), self.bits))).alias("at"))
        cells = at.groupBy(F.shiftright("at", 6).alias("cell")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)))).alias("bits"))
        words = np.zeros(1 << (self.bits - 6), np.int64)
        for row in cells.toLocalIterator():  # at most 2 ** (MOST_BITS - 6) rows, however large the benchmark
            words[row["cell"]] = row["bits"]
        self.words = F.lit(words)

    def may_hold(self, h: Column) -> Column:
        tests = [F.getbit(F.get(self.words, F.shiftright(p, 6)), p.bitwiseAND(F.lit(63))) == 1 for p in _positions(h, self.bits)]
        return tests[0] & tests[1] & tests[2]


def _places(cut: Column) -> Column:
    return F.when(F.size(cut) > 0, F.sequence(F.lit(0), F.size(cut) - 1)).otherwise(F.array().cast("array<int>"))


def fingerprints(features: DataFrame, key: str) -> DataFrame:
    """(key, fp) from rows (key, h, weight): the sign of each bit's weighted votes.

    Weights are counted in 4096ths, so that sums do not depend on the order of rows, even where votes tie.
    """
    features = features.withColumn("weight", F.round(F.col("weight") * 4096).cast("long"))
    votes = [F.sum(F.when(F.getbit("h", F.lit(b)) == 1, F.col("weight")).otherwise(-F.col("weight"))).alias(f"v{b}") for b in range(64)]
    summed = features.groupBy(key).agg(*votes)
    fp = F.lit(0).cast("long")
    for b in range(64):
        fp = fp.bitwiseOR(F.when(F.col(f"v{b}") > 0, F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return summed.select(key, fp.alias("fp"))


def _blocks(fp: str) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(fp, b * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int").alias("value")) for b in range(BLOCKS)]))


def hamming_pairs(windows: DataFrame, items: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(key, item, distance) of all fingerprints of (key, fp) and (item, fp) within ``radius``."""
    wrong = radius // BLOCKS
    masks = F.lit(np.array([m for m in range(1 << BLOCK_BITS) if m.bit_count() <= wrong], np.int32))
    left = windows.select("key", "fp", _blocks("fp").alias("at")).select("key", "fp", "at.block", "at.value")
    right = items.select("item", F.col("fp").alias("item_fp"), _blocks("fp").alias("at")).select("item", "item_fp", "at.block", F.explode(F.transform(masks, lambda m: m.bitwiseXOR(F.col("at.value")))).alias("value"))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    met = left.join(right, (left.block == right.block) & (left.value == right.value) & (distance <= radius))
    return met.select("key", "item", distance.alias("distance")).distinct()


def telling(features: DataFrame, similarity: float) -> DataFrame:
    """(item, h) of (item, h, tf, weight): each item's heaviest shingles, until the others weigh less than ``similarity`` of it."""
    mass = F.col("weight") * F.col("tf")
    heaviest = Window.partitionBy("item").orderBy(F.col("weight").desc(), "h")
    before = F.coalesce(F.sum(mass).over(heaviest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    total = F.sum(mass).over(Window.partitionBy("item"))
    return features.select("item", "h", before.alias("before"), total.alias("total")).where(F.col("before") <= (1 - similarity + 1e-9) * F.col("total")).select("item", "h")


def matches(docs: DataFrame, benchmark: DataFrame, id: str, text: str, item: str, item_text: str, similarity: float, radius: int) -> DataFrame:
    """(doc, digest, item, similarity, start, length, distance) of each window over a text with this digest that holds an item."""
    read = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item).alias("id"), word_hashes(F.col(item_text).cast("string")).alias("words"))
    read = materialize(read.withColumn("item", F.md5(F.array_join("words", ","))), "leak-words")
    names = read.select("item", "id").distinct()
    items = read.groupBy("item").agg(F.any_value("words").alias("words"))
    items = materialize(items.select("item", F.size("words").alias("n"), F.posexplode(shingles(F.col("words"))).alias("q", "h")), "leak-items")
    n_items = items.select(F.count_distinct("item")).first()[0]
    weights = items.groupBy("h").agg(F.log1p(F.lit(float(n_items)) / F.count_distinct("item")).alias("weight"))
    item_features = materialize(items.groupBy("item", "h").agg(F.count(F.lit(1)).alias("tf")).join(weights, "h"), "leak-weights")
    tell = materialize(telling(item_features, similarity), "leak-telling")

    told, known = ShingleMap(tell), ShingleMap(items)
    found = let(shingles, word_hashes(F.col(text).cast("string")), lambda cut: F.when(F.exists(cut, told.may_hold), cut))
    # the row number is not deterministic, so the filter stays above and ``found`` is computed once
    cuts = docs.where(F.col(text).isNotNull()).select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("doc"), F.md5(F.col(text).cast("string")).alias("digest"), found.alias("cut")).where(F.col("cut").isNotNull())
    cuts = materialize(cuts, "leak-documents", files_for(docs.sparkSession, docs.count(), 16_000))
    in_item = F.filter(_places(F.col("cut")), lambda i: known.may_hold(F.get("cut", i)))
    hits = materialize(cuts.select("row", F.size("cut").alias("n_cut"), F.explode(F.transform(in_item, lambda i: F.struct(i.alias("p"), F.get("cut", i).alias("h")))).alias("at")).select("row", "n_cut", "at.p", "at.h"), "leak-hits")

    # only items of which a document holds a telling shingle, then all their shingles there: what many items share pairs nobody
    pairs = hits.select("row", "h").distinct().join(tell, "h").select("row", "item").distinct()
    length = F.least(F.col("n") - SHINGLE + 1, F.col("n_cut"))
    begin = F.greatest(F.lit(0), F.least(F.col("p") - F.col("q"), F.col("n_cut") - length))
    places = pairs.join(items, "item").join(hits, ["row", "h"]).select("row", begin.alias("start"), length.alias("length")).distinct()
    laid = places.join(cuts, "row").select("doc", "digest", "start", "length", F.slice("cut", F.col("start") + 1, F.col("length")).alias("window"))
    laid = materialize(laid.withColumn("key", F.md5(F.array_join("window", ","))), "leak-windows")

    window_features = laid.groupBy("key").agg(F.any_value("window").alias("window")).select("key", F.explode("window").alias("h")).groupBy("key", "h").agg(F.count(F.lit(1)).alias("tf"))
    highest = float(np.log1p(n_items))
    window_features = materialize(window_features.join(weights, "h", "left").select("key", "h", "tf", F.coalesce("weight", F.lit(highest)).alias("weight")), "leak-features")
    weigh = lambda f, key: f.select(key, "h", (F.col("weight") * F.col("tf")).alias("weight"))
    window_fp = materialize(fingerprints(weigh(window_features, "key"), "key"), "leak-fingerprints")
    item_fp = fingerprints(weigh(item_features, "item"), "item")
    near = hamming_pairs(window_fp, item_fp, radius).select("key", "item")
    held = window_features.select("key", "h").join(tell, "h").select("key", "item")
    candidates = near.union(held).distinct()

    both = candidates.join(item_features, "item").join(window_features.select("key", "h", F.col("tf").alias("own")), ["key", "h"], "left")
    shared = F.sum(F.col("weight") * F.least("tf", F.coalesce("own", F.lit(0)))) / F.sum(F.col("weight") * F.col("tf"))
    exact = both.groupBy("key", "item").agg(shared.alias("similarity")).where(F.col("similarity") >= similarity)
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))).alias("distance")
    exact = exact.join(window_fp, "key").join(item_fp.withColumnRenamed("fp", "item_fp"), "item").select("key", "item", "similarity", apart)
    return laid.select("doc", "digest", "start", "length", "key").join(exact, "key").join(names, "item").select("doc", "digest", F.col("id").alias("item"), "similarity", "start", "length", "distance")


def find_leaks(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """One row for each document and item that it holds: id, item, similarity, start and n_words of the window.

    ``start`` counts words. Of several windows the one with the highest similarity, then the first, is told.
    """
    found = matches(docs, benchmark, id, text, item, item_text, similarity, radius)
    best = found.groupBy("doc", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("before"), (-F.col("length")).alias("shorter"), "distance")).alias("best"))
    return best.select(F.col("doc").alias(id), F.col("item").alias(item), F.round("best.similarity", 6).alias("similarity"), (-F.col("best.before")).cast("long").alias("start"), (SHINGLE - 1 - F.col("best.shorter")).cast("long").alias("n_words"), F.col("best.distance").cast("int").alias("distance"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` whose text holds no item of ``benchmark``."""
    leaks = matches(docs, benchmark, id, text, item, item_text, similarity, radius).select("doc", "digest").distinct()
    doc, digest = unused(docs, "doc"), unused(docs, "digest")
    leaks = leaks.select(F.col("doc").alias(doc), F.col("digest").alias(digest))
    return docs.join(leaks, (F.md5(docs[text].cast("string")) == F.col(digest)) & docs[id].eqNullSafe(F.col(doc)), "left_anti")
