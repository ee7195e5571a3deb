"""Correlation graphs of entities, their neighbours and centralities.

Pairs are of entities, not of rows: with C entities on T days there are C * C / 2 pairs of T days each. Neither the
pairs' days nor, where only the strongest are asked for, the pairs leave the task that makes them: entities are packed
into chunks, each two chunks meet in one task, and their moments are products of matrices.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sets import keep_last

#: Of a chunk: entities, and values unless one entity has more. Rows of a tile and days that are dense at once; rows of a batch.
CODES, VALUES, BAND, DAYS, BATCH = 2048, 1 << 18, 256, 512, 1 << 17


def _pack(rows: DataFrame, blocks: int) -> DataFrame:
    """Chunks of whole entities, sorted by code, in ``blocks`` partitions: (block, codes, runs, days, xs); ``xs`` without the entity's mean."""
    code, day = (rows.schema[c].dataType.simpleString() for c in ("code", "day"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunk(t: pa.Table) -> pa.RecordBatch:
            codes, x = t["code"].combine_chunks(), t["x"].to_numpy()
            starts = _starts(codes)
            runs = np.diff(np.append(starts, len(x)))
            x = x - np.repeat(np.add.reduceat(x, starts) / runs, runs)
            columns = [codes.take(pa.array(starts)), pa.array(runs, pa.int32()), t["day"].combine_chunks(), pa.array(x)]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
            return pa.RecordBatch.from_arrays([t["block"].combine_chunks()[:1], *lists], ["block", "codes", "runs", "days", "xs"])

        kept = None
        for b in batches:
            kept = pa.Table.from_batches([b]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([b])])
            while len(kept):
                starts = _starts(kept["code"].combine_chunks())  # the last entity may go on in the next batch
                n = min(CODES, max(1, int(np.searchsorted(starts, VALUES, "right")) - 1))
                if n >= len(starts):
                    break
                yield chunk(kept.slice(0, starts[n]))
                kept = kept.slice(starts[n])
        if kept is not None and len(kept):
            yield chunk(kept)

    dealt = rows.repartitionById(blocks, F.col("block")).sortWithinPartitions("code")
    packed = dealt.mapInArrow(run, f"block int, codes array<{code}>, runs array<int>, days array<{day}>, xs array<double>")
    return packed.repartitionById(blocks, F.col("block"))  # read by many tasks, packed once


def _starts(codes: pa.Array) -> np.ndarray:
    """Where a new code begins."""
    new = pc.not_equal(codes[1:], codes[:-1]).to_numpy(zero_copy_only=False)
    return np.append(0, np.flatnonzero(new) + 1)


class _Side:
    """One chunk of a tile; ``days`` numbers the days that both have, -1 for others."""

    def __init__(self, runs: np.ndarray, days: np.ndarray, x: np.ndarray):
        keep = days >= 0
        self.size, self.rows, self.days, self.x = len(runs), np.repeat(np.arange(len(runs)), runs)[keep], days[keep], x[keep]

    def dense(self, first: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each entity and day: how many values, their mean, and the sum of squares around it (0 unless a day has several)."""
        at = (self.days >= first) & (self.days < first + width)
        flat, x = self.rows[at] * width + self.days[at] - first, self.x[at]
        count = np.bincount(flat, minlength=self.size * width).astype(float)
        mean = np.bincount(flat, x, self.size * width) / np.maximum(count, 1)
        around = np.bincount(flat, (x - mean[flat]) ** 2, self.size * width)
        return tuple(a.reshape(self.size, width) for a in (count, mean, around))


def _refined(a: _Side, b: _Side, total: int, p: np.ndarray, q: np.ndarray, n: np.ndarray, mx: np.ndarray, my: np.ndarray) -> tuple:
    """Variances and covariances of single pairs around their own means; a constant has none at all."""
    vx, vy, c = np.zeros(len(p)), np.zeros(len(p)), np.zeros(len(p))
    lows, highs = np.full((2, len(p)), np.inf), np.full((2, len(p)), -np.inf)
    within = np.zeros((2, len(p)))
    for first in range(0, total, DAYS):
        width = min(DAYS, total - first)
        da, db = a.dense(first, width), b.dense(first, width)
        for s in range(0, len(p), 1024):
            k = slice(s, s + 1024)
            (cx, x, wx), (cy, y, wy) = (m[p[k]] for m in da), (m[q[k]] for m in db)
            both = (cx > 0) & (cy > 0)
            u, v = x - mx[k, None], y - my[k, None]
            vx[k] += (cy * (wx + cx * u * u)).sum(1)
            vy[k] += (cx * (wy + cy * v * v)).sum(1)
            c[k] += (cx * u * cy * v).sum(1)
            within[0, k] += (cy * wx).sum(1)
            within[1, k] += (cx * wy).sum(1)
            for m, own in enumerate((x, y)):
                lows[m, k] = np.minimum(lows[m, k], np.where(both, own, np.inf).min(1))
                highs[m, k] = np.maximum(highs[m, k], np.where(both, own, -np.inf).max(1))
    flat = (lows == highs) & (within == 0)
    return np.where(flat[0], 0, vx / n), np.where(flat[1], 0, vy / n), c / n


def _tile(left: tuple, right: tuple, same: bool, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(corr, n, ranks of the left codes, of the right codes); corr is NaN where there is no pair, or its other order is the one that counts."""
    (lc, lr, ld, lx), (rc, rr, rd, rx) = left, right
    ranks = np.empty(len(lc) + len(rc), np.int64)
    ordered = pa.concat_arrays([lc, rc]).dictionary_encode()
    by_value = np.empty(len(ordered.dictionary), np.int64)
    by_value[pc.array_sort_indices(ordered.dictionary).to_numpy()] = np.arange(len(by_value))
    ranks[:] = by_value[ordered.indices.to_numpy()]
    ri, rj = ranks[: len(lc)], ranks[len(lc) :]
    days = pa.concat_arrays([ld, rd]).dictionary_encode()
    at = days.indices.to_numpy()
    common = np.zeros((2, len(days.dictionary)), bool)
    common[0, at[: len(ld)]] = common[1, at[len(ld) :]] = True
    common = common.all(0)
    total = int(common.sum())
    number = np.where(common, np.cumsum(common) - 1, -1)[at]
    a, b = _Side(lr, number[: len(ld)], lx), _Side(rr, number[len(ld) :], rx)
    corr, n = np.full((a.size, b.size), np.nan), np.zeros((a.size, b.size), np.int32)
    slices = [(first, min(DAYS, total - first)) for first in range(0, total, DAYS)]
    held = [(a.dense(*s), b.dense(*s)) for s in slices] if len(slices) == 1 else None
    for s in range(0, a.size, BAND):
        band = slice(s, s + BAND)
        size = len(ri[band])
        cut = np.zeros((6, size, b.size))
        for each in slices:
            (cx, x, wx), (cy, y, wy) = held[0] if held else (a.dense(*each), b.dense(*each))
            cx, x, wx = cx[band], x[band], wx[band]
            sx, sy = cx * x, cy * y
            for m, (u, v) in enumerate(((cx, cy), (sx, cy), (cx, sy), (wx + sx * x, cy), (cx, wy + sy * y), (sx, sy))):
                cut[m] += u @ v.T
        count, sx, sy, sxx, syy, sxy = cut
        some = np.maximum(count, 1)
        for m in (sx, sy, sxx, syy, sxy):
            m /= some
        vx, vy, c = sxx - sx * sx, syy - sy * sy, sxy - sx * sy
        asked = count >= least
        if same:
            asked &= ri[band, None] < rj[None, :]
        weak = asked & ((vx < 1e-3 * sxx) | (vy < 1e-3 * syy))  # digits were lost
        if weak.any():
            p, q = np.nonzero(weak)
            vx[weak], vy[weak], c[weak] = _refined(a, b, total, p + s, q, count[weak], sx[weak], sy[weak])
        dx, dy = np.sqrt(np.maximum(vx, 0)), np.sqrt(np.maximum(vy, 0))
        asked &= (dx > 1e-12) & (dy > 1e-12)
        np.divide(c, dx * dy, out=corr[band], where=asked)
        n[band] = count
    return corr, n, ri, rj


def _tiles(panel: DataFrame, x: str, blocks: int, run, schema: str) -> DataFrame:
    """``run`` (codes, codes, same block) over each two chunks, once for each two blocks.

    All of the shuffle is the panel itself, twice: a Cartesian product reads the chunks of two partitions, it writes none.
    """
    value = F.col(x).cast("double")
    fit = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")) & F.col("day").isNotNull() & F.col("code").isNotNull()
    rows = panel.where(fit).select("day", "code", value.alias("x"), F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int").alias("block"))
    packed = _pack(rows, blocks)
    left, right = (packed.select(*[F.col(c).alias(f"{c}_{side}") for c in packed.columns]) for side in "lr")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sides = {}
            for k in range(b.num_rows):
                for side in "lr":
                    codes, runs, days, xs = (b.column(f"{c}_{side}")[k].values for c in ("codes", "runs", "days", "xs"))
                    sides[side] = codes, runs.to_numpy(), days, xs.to_numpy()
                yield from run(sides["l"], sides["r"], b.column("block_l")[k].as_py() == b.column("block_r")[k].as_py())

    return left.join(right.hint("shuffle_replicate_nl"), F.col("block_l") <= F.col("block_r")).mapInArrow(each, schema)


def pair_correlations(panel: DataFrame, x: str, least: int, blocks: int = 8) -> DataFrame:
    """(i, j, corr, n) for i < j: Pearson over the days on which both have a value; NaN and infinities count as missing.

    Entities are dealt into ``blocks`` by hash, and each two blocks meet in a task of their own.
    """
    code = panel.schema["code"].dataType.simpleString()

    def run(left: tuple, right: tuple, same: bool) -> Iterator[pa.RecordBatch]:
        corr, n, ri, rj = _tile(left, right, same, least)
        step = max(1, BATCH // corr.shape[1])
        for s in range(0, len(corr), step):
            p, q = np.nonzero(~np.isnan(corr[s : s + step]))
            p += s
            if len(p):
                first = pa.array(ri[p] < rj[q])
                i, j = left[0].take(pa.array(p)), right[0].take(pa.array(q))
                yield pa.RecordBatch.from_arrays([pc.if_else(first, i, j), pc.if_else(first, j, i), pa.array(corr[p, q]), pa.array(n[p, q], pa.int64())], ["i", "j", "corr", "n"])

    return _tiles(panel, x, blocks, run, f"i {code}, j {code}, corr double, n long")


def both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.select("i", "j", "corr").unionByName(pairs.select(F.col("j").alias("i"), F.col("i").alias("j"), "corr"))


def neighbours(pairs: DataFrame, k: int) -> DataFrame:
    """The k strongest by |corr| of each entity; ties go to the smaller code."""
    return _places(both_ways(pairs), k)


def _places(linked: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("i").orderBy(F.abs(F.round("corr", 9)).desc(), "j")
    return linked.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def _nano(c: np.ndarray) -> np.ndarray:
    """|c| in whole billionths, rounded as Spark's round(c, 9) does: half up in the shortest decimal form."""
    scaled = np.abs(c) * 1e9
    out = np.floor(scaled + 0.5).astype(np.int64)
    for k in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-6):
        out[k] = int(Decimal(repr(abs(float(c[k])))).scaleb(9).quantize(Decimal(1), ROUND_HALF_UP))
    return out


def nearest(panel: DataFrame, x: str, least: int, k: int, blocks: int = 8) -> DataFrame:
    """``neighbours`` of ``pair_correlations``, of which a task gives on an entity's k strongest of each chunk only: no other is among its k of all."""
    code = panel.schema["code"].dataType.simpleString()

    def top(i: pa.Array, j: pa.Array, corr: np.ndarray, ranks: np.ndarray) -> pa.RecordBatch:
        size = np.where(np.isnan(corr), -1.0, np.abs(corr))
        bound = np.zeros(len(size)) if size.shape[1] <= k else np.partition(size, -k, axis=1)[:, -k]
        p, q = np.nonzero((size >= 0) & (size >= bound[:, None] - 2e-9))  # with all that round to the same
        by = np.lexsort((ranks[q], -_nano(corr[p, q]), p))
        p, q = p[by], q[by]
        p, q = (m[np.arange(len(p)) - np.searchsorted(p, p) < k] for m in (p, q))
        return pa.RecordBatch.from_arrays([i.take(pa.array(p)), j.take(pa.array(q)), pa.array(corr[p, q])], ["i", "j", "corr"])

    def run(left: tuple, right: tuple, same: bool) -> Iterator[pa.RecordBatch]:
        corr, _, ri, rj = _tile(left, right, same, least)
        yield top(left[0], right[0], corr, rj)
        yield top(right[0], left[0], np.ascontiguousarray(corr.T), ri)

    return _places(_tiles(panel, x, blocks, run, f"i {code} not null, j {code} not null, corr double"), k)  # no filter of nulls tells uses of one result apart


def peer_stats(edges: DataFrame, panel: DataFrame, x: str, least: int = 1) -> DataFrame:
    """Of each entity and day: weighted mean, share over 0 and deviation of its neighbours' values."""
    met = edges.select("i", F.col("j").alias("code"), F.abs("corr").alias("w")).join(panel.where(F.col(x).isNotNull()).select("code", "day", x), "code")
    cut = met.groupBy(F.col("i").alias("code"), "day").agg(F.count(F.lit(1)).alias("n_peers"), (F.sum(F.col("w") * F.col(x)) / F.sum("w")).alias("peer_mean"), F.avg((F.col(x) > 0).cast("double")).alias("peer_up"), F.stddev_pop(x).alias("peer_std"))
    return cut.where(F.col("n_peers") >= least)


def tightness(edges: DataFrame) -> DataFrame:
    """Share of each entity's neighbour pairs that are neighbours themselves (in either direction)."""
    e = edges.select("i", "j").distinct()
    pairs = e.join(e.withColumnRenamed("j", "k"), "i").where("j < k")
    linked = e.select(F.least("i", "j").alias("j"), F.greatest("i", "j").alias("k")).distinct().withColumn("linked", F.lit(1.0))
    return pairs.join(linked, ["j", "k"], "left").groupBy("i").agg(F.avg(F.coalesce("linked", F.lit(0.0))).alias("tightness"))


def two_hop(edges: DataFrame) -> DataFrame:
    """Number of entities two steps from each entity that are not one step away."""
    e = edges.select("i", "j").distinct()
    far = e.join(e.select(F.col("i").alias("j"), F.col("j").alias("k")), "j").where("i <> k").select("i", "k").distinct()
    return far.join(e.select("i", F.col("j").alias("k")), ["i", "k"], "left_anti").groupBy("i").agg(F.count(F.lit(1)).alias("n_two_hop"))


def stability(old: DataFrame, new: DataFrame) -> DataFrame:
    """Share of each entity's old neighbours that it still has."""
    kept = old.select("i", "j").join(new.select("i", "j").withColumn("__k", F.lit(1.0)), ["i", "j"], "left")
    return kept.groupBy("i").agg(F.avg(F.coalesce("__k", F.lit(0.0))).alias("stability"))


def eigen_centrality(edges: DataFrame, rounds: int = 10) -> DataFrame:
    """Centrality by power iteration on |corr|, scaled to a largest value of 1.

    Each round is one join and one aggregate over the edges. Scores are scaled once, at the end: a
    scale in each round would read the round twice, and the plan would double with every round.
    """
    if not 0 < rounds <= 50:
        raise ValueError("between 1 and 50 rounds")
    w = edges.select("i", "j", F.abs("corr").alias("w")).persist()  # read once for each round
    scores = w.select(F.col("i").alias("code")).union(w.select("j")).distinct().withColumn("score", F.lit(1.0))
    for _ in range(rounds):
        scores = w.join(scores.withColumnRenamed("code", "j"), "j").groupBy(F.col("i").alias("code")).agg(F.sum(F.col("w") * F.col("score")).alias("score"))
    top = F.max("score").over(Window.partitionBy(F.lit(1)))
    return scores.select("code", F.when(top > 0, F.col("score") / top).otherwise(0.0).alias("score"))


def donor_beta(panel: DataFrame, edges: DataFrame, x: str) -> DataFrame:
    """Slope of each entity's values on the mean of its neighbours', in all, in rises and in falls."""
    peers = peer_stats(edges, panel, x).select("code", "day", "peer_mean")
    both = panel.where(F.col(x).isNotNull()).join(peers, ["code", "day"])
    slope = lambda c: F.regr_slope(F.when(c, F.col(x)), F.when(c, F.col("peer_mean")))
    return both.groupBy("code").agg(slope(F.lit(True)).alias("beta"), slope(F.col("peer_mean") > 0).alias("beta_up"), slope(F.col("peer_mean") <= 0).alias("beta_down"))


def clusters(pairs: DataFrame, threshold: float):
    """Average-linkage clusters on 1 - |corr|, cut at ``threshold``: {entity: cluster}.

    For metrics, of which there are some hundreds: the pair table is collected, and refused beyond 4 million.
    """
    import numpy as np

    rows = pairs.select("i", "j", "corr").limit(4_000_001).collect()
    if len(rows) > 4_000_000:
        raise ValueError("too many pairs to cluster on one machine")
    names = sorted({r["i"] for r in rows} | {r["j"] for r in rows})
    at = {c: k for k, c in enumerate(names)}
    d = np.ones((len(names), len(names)))
    for r in rows:
        d[at[r["i"]], at[r["j"]]] = d[at[r["j"]], at[r["i"]]] = 1 - abs(r["corr"])
    groups = {k: [k] for k in range(len(names))}
    while len(groups) > 1:
        keys = list(groups)
        best = min(((d[np.ix_(groups[a], groups[b])].mean(), a, b) for n, a in enumerate(keys) for b in keys[n + 1 :]), default=None)
        if best is None or best[0] > threshold:
            break
        groups[best[1]] += groups.pop(best[2])
    return {names[m]: n for n, own in enumerate(sorted(groups.values(), key=min)) for m in own}


def strongest(df: DataFrame, keys: list[str], score: str) -> DataFrame:
    return keep_last(df, keys, [score])
