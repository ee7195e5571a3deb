"""Further queries, one for each operator, registered beside those of ``queries``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .functions import scalar
from .operators import bars, bitemporal, evaluation, grid, market, network, recursive
from .plans import metrics, registry
from .queries import BARS, EVAL, FACTS, GRID, ORDER, QUERIES, SQL, S, day_bars, facts, panel, query, r6, raw_bars, scored, table, w
from .sources import tables
from .sources.tables import Catalog, Dataset, scratch
from .streaming import increments

# --- sources and sinks -------------------------------------------------------------------------


def _catalog(spark, d):
    return Catalog(spark, d, [Dataset("lineitem.parquet", ("l_orderkey", "l_linenumber"), day="l_shipdate", partition=None, code="l_suppkey")])


query("s01_projected_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")(lambda spark, d: _catalog(spark, d).scan("lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"]))
query("s02_whole_table", "SELECT * FROM nation")(lambda spark, d: Catalog(spark, d).scan("nation.parquet"))
query("s03_filtered_scan", "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_shipdate BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' AND l_suppkey IN (1, 3, 5, 7)")(
    lambda spark, d: _catalog(spark, d).scan("lineitem.parquet", ["l_orderkey", "l_linenumber", "l_suppkey"], days=("1995-01-01", "1996-12-31"), codes=[1, 3, 5, 7])
)
query("s11_scaled_bars", "SELECT event_id, hour(ts) AS hr, round(value * 100, 6) + 0.0 AS cents FROM events WHERE hour(ts) IN (9, 10, 11, 14)")(
    lambda spark, d: tables.scaled_bars(table(spark, d, "events").select("event_id", F.hour("ts").alias("hr"), F.col("value").alias("cents")), "hr", [9, 10, 11, 14], {"cents": 100.0}).select("event_id", "hr", r6("cents").alias("cents"))
)


def _written(spark, d, write):
    path = scratch(spark, "sink")
    write(path)
    return spark.read.parquet(path)


def _snapshot(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")

    def write(path):
        tables.replace_snapshot(orders.where("o_orderkey > 10"), path)
        tables.replace_snapshot(orders, path)

    return _written(spark, d, write)


query("s14_snapshot", "SELECT o_orderkey, o_custkey FROM orders")(_snapshot)


def _partitions(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))

    def write(path):  # the second write replaces one year and leaves the others
        tables.write_partitions(rows.withColumn("o_custkey", F.when(F.col("year") == 1995, F.lit(0)).otherwise(F.col("o_custkey")).cast("bigint")), path, "year", ["o_orderkey"])
        tables.write_partitions(rows.where("year = 1995"), path, "year", ["o_orderkey"])

    return _written(spark, d, write).select("o_orderkey", "o_custkey", F.col("year").cast("long").alias("year"))


query("s15_partitions", "SELECT o_orderkey, o_custkey, year(o_orderdate) AS year FROM orders")(_partitions)
query("s16_contract", "SELECT r_regionkey, r_name FROM region")(lambda spark, d: tables.check_contract(table(spark, d, "region"), StructType.fromDDL("r_regionkey int, r_name string")))


def _buffered(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", F.to_date("ts").alias("day"))

    def write(path):
        buffer = tables.WriteBuffer(lambda df: df.write.mode("append").parquet(path), least=300)
        for (day,) in sorted(events.select("day").distinct().collect()):
            buffer.add(events.where(F.col("day") == day))
        buffer.flush()

    return _written(spark, d, write)


query("s17_write_buffer", "SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events")(_buffered)
query("s18_cast_like", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, CAST(NULL AS DOUBLE) AS extra, o_orderstatus FROM orders")(
    lambda spark, d: tables.cast_like(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), StructType.fromDDL("o_orderkey string, o_custkey int, extra double"))
)
query("s17_audit", f"WITH {FACTS} SELECT day, code, count(*) AS n FROM (SELECT * FROM facts UNION ALL SELECT * FROM facts WHERE errors > 0) GROUP BY day, code HAVING count(*) > 1")(
    lambda spark, d: (lambda f: tables.audit(f.unionByName(f.where("errors > 0")), f.select("day").distinct(), ["day", "code"]).duplicates)(facts(spark, d))
)


# --- scalar functions and row predicates -------------------------------------------------------

_Q = "l_quantity - 25 + CASE WHEN l_linenumber % 2 = 0 THEN 1e-13 ELSE 0 END"


def _tolerant(spark, d):
    a = F.col("l_quantity") - 25 + F.when(F.col("l_linenumber") % 2 == 0, F.lit(1e-13)).otherwise(0.0)
    b = F.col("l_linenumber") * 0.0
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", scalar.gt(a, b).alias("gt"), scalar.ge(a, b).alias("ge"), scalar.lt(a, b).alias("lt"), scalar.le(a, b).alias("le"))


query("p05_tolerant", f"SELECT l_orderkey, l_linenumber, a > 1e-12 AS gt, a >= -1e-12 AS ge, a < -1e-12 AS lt, a <= 1e-12 AS le FROM (SELECT l_orderkey, l_linenumber, {_Q} AS a FROM lineitem)")(_tolerant)
query("p06_floor_ceil", "SELECT l_orderkey, l_linenumber, CAST(floor(l_tax * 37) AS BIGINT) AS low, CAST(ceil(l_tax * 37) AS BIGINT) AS high, least(greatest(l_quantity, 10.0), 40.0) AS clamped FROM lineitem")(
    lambda spark, d: table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.floor(F.col("l_tax") * 37).alias("low"), F.ceil(F.col("l_tax") * 37).alias("high"), scalar.clamp("l_quantity", 10.0, 40.0).alias("clamped"))
)
query("p07_finite", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity NOT IN (10, 20, 30) THEN l_quantity END AS value FROM lineitem")(
    lambda spark, d: table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_quantity") == 10, F.lit(float("nan"))).when(F.col("l_quantity") == 20, F.lit(float("inf"))).when(F.col("l_quantity") == 30, F.lit(float("-inf"))).otherwise(F.col("l_quantity")).alias("value")).transform(tables.clean_numbers)
)
query("p09_on_sessions", f"WITH {FACTS} SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_suppkey = 1)")(
    lambda spark, d: grid.on_sessions(table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day")), table(spark, d, "lineitem").where("l_suppkey = 1").select(F.to_date("l_shipdate").alias("day")))
)
query("p11_positive_only", "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS value FROM customer")(lambda spark, d: table(spark, d, "customer").select("c_custkey", scalar.positive_only("c_acctbal").alias("value")))
query("p12_valid_bar", f"WITH {BARS} SELECT event_id, coalesce(least(open, high, low, close) > 0 AND high >= greatest(open, close) AND low <= least(open, close), FALSE) AS ok FROM b")(
    lambda spark, d: raw_bars(spark, d).select("event_id", scalar.valid_bar(F.col("open"), F.col("high"), F.col("low"), F.col("close")).alias("ok"))
)
query("p13_price_limits", "SELECT p_partkey, floor(p_retailprice * 1.1 * 100 + 0.5) / 100 AS up, floor(p_retailprice * 0.9 * 100 + 0.5) / 100 AS down FROM part")(
    lambda spark, d: table(spark, d, "part").select("p_partkey", scalar.price_limit("p_retailprice").alias("up"), scalar.price_limit("p_retailprice", up=False).alias("down"))
)
query("p16_variant", "SELECT n_nationkey, 'main' AS board, 5 AS minutes FROM nation")(lambda spark, d: tables.with_variant(table(spark, d, "nation").select("n_nationkey"), board="main", minutes=5))
query("p17_guarded_winsor", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN least(greatest(l_quantity, 10.0), 30.0) ELSE l_quantity END AS value FROM lineitem")(
    lambda spark, d: table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", scalar.winsor_guarded(F.col("l_quantity"), F.lit(10.0), F.when(F.col("l_linenumber") % 2 == 0, 30.0).otherwise(10.0)).alias("value"))
)
query("x09_strings", "SELECT p_partkey, ends_with(p_brand, '1') OR ends_with(p_brand, '3') AS odd, upper(replace(p_name, ' ', '')) AS name FROM part")(
    lambda spark, d: table(spark, d, "part").select("p_partkey", scalar.any_suffix("p_brand", ["1", "3"]).alias("odd"), scalar.plain_name("p_name").alias("name"))
)
query("x09_math", "SELECT c_custkey, round(tanh(c_acctbal / 1000), 6) + 0.0 AS squashed, round(asinh(c_acctbal), 6) + 0.0 AS soft FROM customer")(
    lambda spark, d: table(spark, d, "customer").select("c_custkey", r6(scalar.squash("c_acctbal", 1000.0)).alias("squashed"), r6(scalar.soft_log("c_acctbal")).alias("soft"))
)


# --- grids and joins ---------------------------------------------------------------------------

query("g02_day_mask", f"WITH {FACTS}, c AS (SELECT day, row_number() OVER (ORDER BY day) AS session FROM (SELECT DISTINCT day FROM facts)) SELECT day, session, day IN (SELECT day FROM facts WHERE errors >= 3) AS wanted FROM c")(
    lambda spark, d: (lambda f: grid.day_mask(f, f.where("errors >= 3")).select("day", F.col("session").cast("long").alias("session"), "wanted"))(facts(spark, d))
)
query("g02_places", f"WITH {FACTS}, c AS (SELECT day, row_number() OVER (ORDER BY day) AS session FROM (SELECT DISTINCT day FROM facts)) SELECT o.day, c.session FROM (SELECT DISTINCT CAST(ts AS DATE) + 5 AS day FROM events) o LEFT JOIN c ON c.day = o.day")(
    lambda spark, d: grid.session_places(facts(spark, d), table(spark, d, "events").select(F.date_add(F.to_date("ts"), 5).alias("day"))).select("day", F.col("session").cast("long").alias("session"))
)
query("g05_code_index", "SELECT code, row_number() OVER (ORDER BY code) - 1 AS place FROM (SELECT DISTINCT c_name AS code FROM customer)")(lambda spark, d: grid.code_index(table(spark, d, "customer").select(F.col("c_name").alias("code"))).select("code", F.col("place").cast("long").alias("place")))
query("j12_coupled", f"{GRID} SELECT code, day, round(x * y, 6) + 0.0 AS value FROM grid WHERE x IS NOT NULL AND y > 0")(
    lambda spark, d: evaluation.merge_scores(panel(spark, d).where("x is not null").select("day", "code", F.col("x").alias("score")), panel(spark, d).where("y > 0").select("day", "code", F.col("y").alias("score"))).select("code", "day", r6(F.col("a") * F.col("b")).alias("value"))
)
query("j13_merged_scores", f"{GRID} SELECT a.code, a.day, round(a.x, 6) + 0.0 AS first, round(b.y, 6) + 0.0 AS second FROM grid a JOIN grid b ON a.code = b.code AND a.day = b.day WHERE a.vol > 1 AND b.errors > 0")(
    lambda spark, d: evaluation.merge_scores(panel(spark, d).where("vol > 1").withColumnRenamed("x", "score"), panel(spark, d).where("errors > 0").withColumnRenamed("y", "score"), ("first", "second")).select("code", "day", r6("first").alias("first"), r6("second").alias("second"))
)
query("j14_pool", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")(
    lambda spark, d: tables.in_pool(table(spark, d, "orders").select("o_orderkey", "o_custkey"), table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey")), "o_custkey").select("o_orderkey", "o_custkey")
)
query("j14_suffix_anti", "SELECT c_custkey, c_name FROM customer WHERE right(c_name, 1) NOT IN (SELECT DISTINCT right(s_name, 1) FROM supplier WHERE s_suppkey < 4)")(
    lambda spark, d: tables.without_suffixes(table(spark, d, "customer").select("c_custkey", "c_name"), "c_name", table(spark, d, "supplier").where("s_suppkey < 4").select(F.right("s_name", F.lit(1)).alias("s")), "s", 1)
)
query("j17_validity", f"{GRID}, src AS (SELECT code, day AS src, errors FROM facts WHERE errors > 0) SELECT g.code, g.day, (SELECT arg_max(s.errors, s.src) FROM src s WHERE s.code = g.code AND s.src <= g.day AND g.day - s.src <= 3) AS errors FROM grid g")(
    lambda spark, d: (lambda p: grid.asof(p.select("day", "code"), facts(spark, d).where("errors > 0").select("code", "day", F.col("errors").alias("open_errors")), ["open_errors"], max_age=3).select("code", "day", F.col("open_errors").alias("errors")))(panel(spark, d))
)
query("t08_latest_rows", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 2")(lambda spark, d: tables.latest_rows(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 2).select("o_custkey", "o_orderkey"))
query("w22_own_percentile", f"{GRID}, g AS (SELECT *, count(x) OVER {w(15)} AS k FROM grid) SELECT code, day, round(CASE WHEN n >= 15 AND k >= 10 AND x IS NOT NULL THEN (SELECT count(*) FROM grid b WHERE b.code = a.code AND b.n BETWEEN a.n - 14 AND a.n AND b.x < a.x) / (k - 1) END, 6) + 0.0 AS value FROM g a")(
    lambda spark, d: panel(spark, d).select("code", "day", r6(S.rank(F.col("x"), 15, 10)).alias("value"))
)
query("l06_strict_field", f"{GRID} SELECT code, day, vol FROM grid")(lambda spark, d: grid.place(grid.build(facts(spark, d).select("day").distinct(), facts(spark, d).select("code").distinct()), facts(spark, d).select("day", "code", "vol")).select("code", "day", "vol"))
query("st15_lagged_table", f"{GRID} SELECT code, day, lag(vol, 2) OVER {ORDER} AS vol FROM grid")(
    lambda spark, d: (lambda f: grid.place(grid.build(f.select("day").distinct(), f.select("code").distinct()), grid.available_from(f.select("day", "code", "vol"), f.select("day"), 2)).select("code", "day", "vol"))(facts(spark, d))
)


# --- reports -----------------------------------------------------------------------------------


def _lagged(spark, d):
    from .queries import vintages

    v = vintages(spark, d)
    out = bitemporal.lagged_trailing_year(bitemporal.revision_events(v), v, "val", "value", 4)
    return out.select("code", "period", "pit", r6("value").alias("value"))


query("f03_lagged_trailing_year")(_lagged)
query("f06_known_on", "SELECT o_orderkey, greatest(CAST(o_orderdate AS DATE), max(CAST(l_shipdate AS DATE))) AS pit FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate")(
    lambda spark, d: table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max(F.to_date("l_shipdate")).alias("shipped")).join(table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("ordered")), "o_orderkey").select("o_orderkey", bitemporal.known_on(F.col("ordered"), F.col("shipped")).alias("pit"))
)


# --- layers of daily fields --------------------------------------------------------------------

_LAYER_PARTS = {"a01_daily_bars": None, "a03_extreme_places": None, "a04_path": None, "a06_sessions": None, "a09_tail_bars": "tail_ret, tail_share", "t04_top_bars": None}
_LAYER_SQL = " JOIN ".join((f"({SQL[n]})" if c is None else f"(SELECT code, day, {c} FROM ({SQL[n]}))") + f" q{i}" + (" USING (code, day)" if i else "") for i, (n, c) in enumerate(_LAYER_PARTS.items()))
_ROUND = {"sum_r": 4, "sum_abs_r": 4, "sum_up_r2": 3, "sum_down_r2": 6, "high_place": 6, "low_place": 6, "max_drawdown": 9, "max_runup": 9, "am_ret": 9, "am_share": 6, "tail_ret": 9, "tail_share": 6, "top_share": 6}
_PLAIN = ["open", "close", "high", "low", "vol", "n_bars", "n_up", "n_flat", "am_vol", "pm_vol"]
query("m16_intraday_layer", f"SELECT * FROM {_LAYER_SQL}")(lambda spark, d: bars.intraday_layer(day_bars(spark, d), F.col("hr") < 12).select("code", "day", *_PLAIN, *[F.round(c, n).alias(c) for c, n in _ROUND.items()]))
query("m16_opening", f"WITH {BARS} SELECT code, day, round(arg_min(vol * close, slot), 4) + 0.0 AS open_amount, round(sum(vol * close), 4) + 0.0 AS day_amount, count(*) AS n_bars, arg_min(hr, slot) AS first_time FROM b GROUP BY ALL")(
    lambda spark, d: bars.opening(day_bars(spark, d), "hr").select("code", "day", F.round("open_amount", 4).alias("open_amount"), F.round("day_amount", 4).alias("day_amount"), "n_bars", "first_time")
)
query("m16_morning", f"WITH {BARS} SELECT code, day, arg_min(open, slot) AS open, arg_max(close, slot) AS close, max(high) AS high, min(low) AS low, CAST(sum(vol) AS BIGINT) AS vol, count(*) AS n_bars, count(DISTINCT hr) = 12 AND max(hr) = 11 AS is_complete FROM b WHERE hr <= 11 GROUP BY ALL")(
    lambda spark, d: bars.morning_bars(day_bars(spark, d), "hr", 11, 12)
)
query("m16_closing", f"WITH {BARS} SELECT code, day, CAST(sum(vol) FILTER (WHERE slot >= n_slots - 6) AS BIGINT) AS tail_vol, round(arg_max(close, slot) / arg_min(open, slot) FILTER (WHERE slot >= n_slots - 6) - 1, 9) + 0.0 AS tail_ret FROM b GROUP BY ALL")(
    lambda spark, d: bars.edge(day_bars(spark, d), 6, head=False).select("code", "day", "tail_vol", F.round("tail_ret", 9).alias("tail_ret"))
)
query("m16_head_bars", f"WITH {BARS} SELECT code, day, CAST(sum(vol) FILTER (WHERE slot < 2) AS BIGINT) AS head_vol, round(arg_max(close, slot) FILTER (WHERE slot < 2) / arg_min(open, slot) FILTER (WHERE slot < 2) - 1, 9) + 0.0 AS head_ret FROM b GROUP BY ALL")(
    lambda spark, d: bars.edge(day_bars(spark, d), 2, head=True).select("code", "day", "head_vol", F.round("head_ret", 9).alias("head_ret"))
)
query("m16_minute_structure", f"WITH {BARS}, a AS (SELECT *, vol * close AS amount, vol * close / sum(vol * close) OVER (PARTITION BY code, day) AS s FROM b) SELECT code, day, CAST(count(*) AS INTEGER) AS n_slots, round(sum(s * s), 6) + 0.0 AS concentration, round(sum(s * slot) / greatest(count(*) - 1, 1), 6) + 0.0 AS centre, round(max(s), 6) + 0.0 AS largest, round(coalesce(sum(r), 0), 4) + 0.0 AS sum_ret FROM a GROUP BY ALL")(
    lambda spark, d: bars.slot_structure(bars.slot_arrays(day_bars(spark, d))).select("code", "day", "n_slots", *[F.round(c, 4 if c == "sum_ret" else 6).alias(c) for c in ("concentration", "centre", "largest", "sum_ret")])
)
query("a07_units", f"WITH {BARS} SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(vol AS BIGINT) * 100 ELSE vol END AS vol FROM b")(
    lambda spark, d: bars.normalize_units(raw_bars(spark, d).withColumn("amount", F.when(F.col("event_id") % 3 == 0, F.col("amount") * 100).otherwise(F.col("amount")))).select("event_id", "vol")
)


# --- evaluation and fusion ---------------------------------------------------------------------

query("a26_ridge", f"{EVAL} SELECT '1' AS name, round(regr_intercept(ret, score), 6) + 0.0 AS coefficient FROM e UNION ALL SELECT 'score', round(regr_slope(ret, score), 6) + 0.0 FROM e")(lambda spark, d: evaluation.ridge_table(scored(spark, d), "ret", ["score"], 0.0).select("name", r6("coefficient").alias("coefficient")))
query("b01_axes", f"{GRID} SELECT DISTINCT code, day FROM grid WHERE x > 8 OR errors > 0")(lambda spark, d: registry.axes({"a": panel(spark, d).where("x > 8"), "b": panel(spark, d).where("errors > 0")}).select("code", "day"))
query("b04_market_block", f"WITH {FACTS}, m AS (SELECT day, round(avg(ln(cents + 10.0)), 9) AS level, row_number() OVER (ORDER BY day) AS n FROM facts GROUP BY day), z AS (SELECT *, avg(level) OVER q AS a, stddev_pop(level) OVER q AS s, count(*) OVER q AS k FROM m WINDOW q AS (ORDER BY day ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) SELECT day, round(level, 6) + 0.0 AS level, round(CASE WHEN k >= 5 AND s > 1e-12 THEN (level - a) / s END, 5) + 0.0 AS level_z10 FROM z")(
    lambda spark, d: evaluation.market_block(facts(spark, d).groupBy("day").agg(F.round(F.avg(F.log(F.col("cents") + 10.0)), 9).alias("level")), ["level"], 10, 5).select("day", r6("level").alias("level"), F.round("level_z10", 5).alias("level_z10"))
)
query("b05_sampled_names", "SELECT name FROM (SELECT DISTINCT p_brand AS name FROM part) ORDER BY md5('11:' || name) LIMIT 7")(lambda spark, d: evaluation.sample_names(table(spark, d, "part").select(F.col("p_brand").alias("name")), 7, 11))
query("b09_verified_labels", f"{EVAL} SELECT count(*) AS n_checked, count(*) FILTER (WHERE n3) AS n_off FROM (SELECT code % 5 = 0 AS n3 FROM ev WHERE ret IS NOT NULL)")(
    lambda spark, d: evaluation.verify_labels(scored(spark, d).withColumn("label", F.col("ret") + F.when(F.col("code") % 5 == 0, 0.01).otherwise(0.0)), "label", F.col("ret"))
)
_PCT = "(rank() OVER (PARTITION BY day, {c} IS NULL ORDER BY {c}) + (count(*) OVER (PARTITION BY day, {c}) - 1) / 2.0) / count({c}) OVER (PARTITION BY day)"
query("b16_blended_ranks", f"{GRID}, p AS (SELECT code, day, CASE WHEN x IS NOT NULL THEN {_PCT.format(c='x')} END AS a, CASE WHEN y IS NOT NULL THEN {_PCT.format(c='y')} END AS b FROM grid) SELECT code, day, round((coalesce(0.7 * a, 0) + coalesce(0.3 * b, 0)) / nullif(CASE WHEN a IS NULL THEN 0 ELSE 0.7 END + CASE WHEN b IS NULL THEN 0 ELSE 0.3 END, 0), 9) + 0.0 AS score FROM p")(
    lambda spark, d: evaluation.blend_ranks(panel(spark, d), {"x": 0.7, "y": 0.3}).select("code", "day", F.round("score", 9).alias("score"))
)
query("b16_ridge_blend", f"{EVAL}, k AS (SELECT regr_slope(ret, score) AS s, regr_intercept(ret, score) AS i FROM e) SELECT code, day, round(i + s * score, 6) + 0.0 AS blended FROM ev, k")(lambda spark, d: evaluation.blend_ridge(scored(spark, d), ["score"], "ret", 0.0, "blended").select("code", "day", r6("blended").alias("blended")))
query("b17_market_risk", "SELECT c_custkey, round(1 / (1 + exp(-(0.5 + 0.001 * c_acctbal))), 6) + 0.0 AS risk FROM customer")(lambda spark, d: recursive.market_risk(table(spark, d, "customer"), {"c_acctbal": 0.001}, 0.5).select("c_custkey", r6("risk").alias("risk")))
query("b17_budget", f"{GRID}, s AS (SELECT *, CASE WHEN x > 9.5 THEN 0.5 WHEN x < 8.5 THEN 1.0 END AS said FROM grid) SELECT code, day, coalesce(last_value(said IGNORE NULLS) OVER (PARTITION BY code ORDER BY day ROWS UNBOUNDED PRECEDING), 1.0)::DOUBLE AS budget FROM s")(
    lambda spark, d: recursive.hysteresis(panel(spark, d).select("code", "day", "x"), "x", "budget", 9.5, 8.5).select("code", "day", "budget")
)
query("b18_archive", f"WITH {FACTS}, h AS (SELECT day, sha256(concat_ws('|', code, CAST(cents AS VARCHAR), CAST(vol AS VARCHAR))) AS h FROM facts) SELECT day, count(*) AS n_rows, sha256(string_agg(h, ',' ORDER BY h)) AS sha256 FROM h GROUP BY day")(lambda spark, d: _archive(spark, d))


def _archive(spark, d):
    path = scratch(spark, "archive")
    rows = facts(spark, d).select("day", "code", "cents", "vol")
    first = rows.where("day < '2024-01-10'")
    evaluation.archive_scores(first, path, "r1", ["cents", "vol"])
    evaluation.archive_scores(rows, path, "r1", ["cents", "vol"])  # days that are there are not written again
    return spark.read.parquet(f"{path}/hashes").select("day", "n_rows", "sha256")


query("b19_fused", f"{GRID}, f AS (SELECT code, day, x, y FROM grid WHERE x IS NOT NULL AND y IS NOT NULL) SELECT code, day, round(0.6 * CASE WHEN stddev_pop(x) OVER q > 1e-12 THEN (x - avg(x) OVER q) / stddev_pop(x) OVER q ELSE 0 END + 0.4 * CASE WHEN stddev_pop(y) OVER q > 1e-12 THEN (y - avg(y) OVER q) / stddev_pop(y) OVER q ELSE 0 END, 5) + 0.0 AS score FROM f WINDOW q AS (PARTITION BY day)")(
    lambda spark, d: evaluation.fuse_common(panel(spark, d), {"x": 0.6, "y": 0.4}).select("code", "day", F.round("score", 5).alias("score"))
)
query("b21_sign_adjusted", "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount < 0.05 THEN l_tax ELSE l_quantity END AS value FROM lineitem")(lambda spark, d: evaluation.sign_adjusted(table(spark, d, "lineitem").withColumn("ic", F.col("l_discount") - 0.05), "ic", "l_quantity", "l_tax", "value").select("l_orderkey", "l_linenumber", "value"))
query("n04_stability", f"SELECT i, round(avg(CASE WHEN kept THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS stability FROM (SELECT i, j % 2 = 0 AS kept FROM (SELECT n_nationkey AS i, c_custkey AS j FROM nation JOIN customer ON c_nationkey = n_nationkey)) GROUP BY i")(
    lambda spark, d: (lambda e: network.stability(e, e.where("j % 2 = 0")).select("i", r6("stability").alias("stability")))(table(spark, d, "customer").select(F.col("c_nationkey").alias("i"), F.col("c_custkey").alias("j")))
)


# --- increments and the registry ---------------------------------------------------------------

query("st01_newest_complete_day", f"WITH {FACTS}, c AS (SELECT code, day, vol AS n FROM facts), r AS (SELECT code, max(vol) AS want FROM facts GROUP BY code) SELECT c.code, max(day) AS day FROM c JOIN r ON c.code = r.code WHERE n >= 0.7 * want GROUP BY c.code")(
    lambda spark, d: (lambda f: increments.newest_complete_day(f.select(F.col("code").alias("table"), "day", F.col("vol").alias("n")), f.groupBy(F.col("code").alias("table")).agg(F.max("vol").alias("n")), 0.7).select(F.col("table").alias("code"), "day"))(facts(spark, d))
)


def _late(spark, d):
    merge, late = increments.split_late(facts(spark, d).select("code", "day"), "day", "2024-01-20", 10)
    return merge.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))


query("st06_late_rows", f"WITH {FACTS} SELECT code, day, day < DATE '2024-01-10' AS late FROM facts")(_late)


def _once(spark, d):
    stream = increments.file_stream(spark, f"{d}/events.parquet", table(spark, d, "events").schema)
    path = scratch(spark, "once")
    kept = increments.first_of_key(stream.select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type"), "ts", ["user_id", "event_type"], "90 days")
    kept.select("user_id", "event_type").writeStream.format("parquet").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start(f"{path}/data").awaitTermination()
    return spark.read.parquet(f"{path}/data").select("user_id", "event_type")


query("st07_keys_once", "SELECT DISTINCT user_id, event_type FROM events")(_once)


def _restarted(spark, d):
    """A stream that is given its last batch again after a failure."""
    path = scratch(spark, "restart")
    t = increments.UpsertTable(spark, path, ["event_id"], ["value"], "event_type")
    events = table(spark, d, "events").select("event_id", "event_type", "value")
    t.merge(events.where("event_id % 3 <> 0").withColumn("value", F.lit(0.0)), 0)
    t.merge(events, 1)
    t.merge(events.withColumn("value", F.lit(-1.0)), 1)
    return t.read().select("event_id", "event_type", "value")


query("st14_replayed_batches", "SELECT event_id, event_type, value FROM events")(_restarted)


def _moved(spark, d):
    """Keys that arrive in another partition, and rows without one."""
    t = increments.UpsertTable(spark, scratch(spark, "moved"), ["event_id"], ["value"], "part")
    events = table(spark, d, "events").select("event_id", "value", F.when(F.col("user_id") % 4 > 0, F.concat(F.lit("p/"), (F.col("user_id") % 4).cast("string"))).alias("part"))
    t.merge(events.withColumn("part", F.lit("old")), 0)
    t.merge(events, 1)
    return t.read().select("event_id", "value", "part")


query("st05_moved_keys", "SELECT event_id, value, CASE WHEN user_id % 4 > 0 THEN 'p/' || (user_id % 4) END AS part FROM events")(_moved)


def _registry(spark: SparkSession) -> registry.Registry:
    reg = registry.Registry(tables.Catalog(spark, ""), {"lagged": lambda p: registry.Metric(p["name"], lambda ctx: ctx.grid.select("day", "code", S.shift(F.col("x"), p["n"]).alias("value")), warmup=p["n"])})
    reg.build([{"builder": "lagged", "parameters": {"name": "x1", "n": 1}}, {"builder": "lagged", "parameters": {"name": "x3", "n": 3}}])
    reg.add(registry.Metric("broken", lambda ctx: ctx.grid.select("day", "code", F.raise_error(F.lit("no such price")).cast("double").alias("value"))))
    reg.add(registry.Metric("child", lambda ctx: ctx.parent("broken").select("day", "code", "value"), parents=("broken",)))
    reg.add(registry.Metric("double", lambda ctx: ctx.parent("x1").select("day", "code", (F.col("value") * 2).alias("value")), parents=("x1",)))
    return reg


def _executed(spark, d) -> DataFrame:
    store = scratch(spark, "products")
    dense, reg = panel(spark, d), _registry(spark)
    done = registry.execute(reg, ["x1", "x3", "child", "double"], dense, store, least=20)
    again = registry.execute(reg, ["x1", "double"], dense, store, least=20, resume=True)
    return spark.createDataFrame([(n, s) for n, s, _ in [*done, *[(f"again {n}", s, e) for n, s, e in again]]], "name string, state string")


query("u05_execution", "SELECT * FROM (VALUES ('x1', 'done'), ('x3', 'done'), ('broken', 'failed'), ('child', 'blocked'), ('double', 'done'), ('again x1', 'kept'), ('again double', 'kept')) t(name, state)")(_executed)


def _product(spark, d) -> DataFrame:
    store = scratch(spark, "products")
    registry.execute(_registry(spark), ["double"], panel(spark, d), store, least=20)
    return registry.stored(spark, store, "double").select("code", "day", F.round(F.col("value").cast("double"), 3).alias("value"))


query("u02_built_metric", f"{GRID} SELECT code, day, round(CAST(CAST(CAST(lag(x) OVER {ORDER} AS FLOAT) * 2 AS FLOAT) AS DOUBLE), 3) + 0.0 AS value FROM grid")(_product)
query("u06_aligned", f"{GRID}, f AS (SELECT min(day) AS first FROM grid WHERE day >= DATE '2024-01-06') SELECT code, day, CASE WHEN day < first THEN 0.0 ELSE round(x, 6) + 0.0 END AS value FROM grid, f")(
    lambda spark, d: (lambda p: registry.align(p.where("day >= '2024-01-06'").select("day", "code", F.col("x").alias("value")), p.select("day").distinct(), p.select("code").distinct(), 0.0).select("code", "day", r6("value").alias("value")))(panel(spark, d))
)
query("u09_market_fields", f"WITH {FACTS} SELECT day, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents, CAST(sum(vol) AS BIGINT) AS vol, round(avg(ln(cents + 10.0)), 6) + 0.0 AS mean_log, round(stddev_pop(ln(cents + 10.0)), 6) + 0.0 AS spread, count(*) FILTER (WHERE errors > 0) AS n_errors, round(quantile_cont(CAST(vol AS DOUBLE), 0.5), 6) + 0.0 AS median_vol FROM facts GROUP BY day")(
    lambda spark, d: market.fields(facts(spark, d), {"n": F.count(F.lit(1)), "cents": F.sum("cents"), "vol": F.sum("vol"), "mean_log": F.round(F.avg(F.log(F.col("cents") + 10.0)), 6), "spread": F.round(F.stddev_pop(F.log(F.col("cents") + 10.0)), 6), "n_errors": F.count_if(F.col("errors") > 0), "median_vol": F.round(F.percentile(F.col("vol").cast("double"), 0.5), 6)})
)



# --- registered metrics ------------------------------------------------------------------------

_M = {
    "reversal": "(x - lag(x, 5) OVER o)", "to_high": "CASE WHEN n >= 10 AND count(x) OVER w10 = 10 THEN x / max(x) OVER w10 - 1 END", "from_low": "CASE WHEN n >= 10 AND count(x) OVER w10 = 10 THEN x / min(x) OVER w10 - 1 END",
    "vol_ratio": "CASE WHEN n >= 10 AND count(v) OVER w5 >= 2 AND count(v) OVER w10 >= 5 AND avg(v) OVER w10 > 0 THEN avg(v) OVER w5 / avg(v) OVER w10 END", "vol_stability": "CASE WHEN n >= 10 AND count(v) OVER w10 >= 5 THEN stddev_pop(v) OVER w10 END",
    "acceleration": "(x - lag(x, 3) OVER o) - (x - lag(x, 8) OVER o)", "error_share": "CASE WHEN n >= 5 AND count(v) OVER w5 >= 3 AND sum(v) OVER w5 > 0 THEN sum(e) OVER w5 / sum(v) OVER w5 END",
}
_METRICS_SQL = f"""{GRID}, b AS (SELECT code, day, n, x, CAST(vol AS DOUBLE) AS v, CAST(errors AS DOUBLE) AS e FROM grid)
SELECT code, day, {", ".join(f"round({sql}, 6) + 0.0 AS {name}" for name, sql in _M.items())} FROM b
WINDOW o AS (PARTITION BY code ORDER BY day), w5 AS (PARTITION BY code ORDER BY day ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), w10 AS (PARTITION BY code ORDER BY day ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"""


def _metrics(spark, d):
    rows = panel(spark, d).select("code", "day", "x", F.col("vol").cast("double").alias("v"), F.col("errors").cast("double").alias("e"))
    specs = [
        ("reversal", "difference", {"x": "x", "n": 5}), ("to_high", "to_high", {"x": "x", "n": 10}), ("from_low", "from_low", {"x": "x", "n": 10}), ("vol_ratio", "mean_ratio", {"x": "v", "short": 5, "long": 10, "least": (2, 5)}),
        ("vol_stability", "deviation", {"x": "v", "n": 10, "least": 5}), ("acceleration", "acceleration", {"x": "x", "short": 3, "long": 8}), ("error_share", "sum_ratio", {"x": "e", "y": "v", "n": 5, "least": 3}),
    ]
    return metrics.together(rows, specs).select("code", "day", *[r6(n).alias(n) for n, _, _ in specs])


query("u09_metrics_together", _METRICS_SQL)(_metrics)

#: Queries whose tables were cut; these run over whole ones in their place, with the SQL without the cut.
NETWORK = [("code < 40 AND ", "")]
SPANS = [("o_custkey % 100 AS code", "o_custkey AS code"), (" WHERE o_orderkey % 10 = 0", "")]
WHOLE: dict[str, list[tuple[str, str]]] = {n: NETWORK for n in ("n01_pair_correlations", "n02_neighbours", "n03_peer_stats", "n04_tightness", "n04_two_hop", "n06_donor_beta")} | {
    "s20_merge_intervals": SPANS, "s20_missing_intervals": SPANS, "s13_replace_days": [("event_id % 2 = 0 AND ", "")], "s10_unpack_dump": [(" WHERE event_id % 50 = 0", "")],
    "j01_asof": [(" WHERE event_id % 3 = 0", "")], "j01_asof_strict_aged": [(" WHERE event_id % 3 = 0", "")], "r07_others": [(" AND code % 7 = 0", "")], "g09_session_runs": [("l_suppkey % 10 = 1 AND ", "")],
}


def registered() -> tuple[dict, dict]:
    """(queries, SQL) for the driver: every query over its whole tables, under one name."""
    run, sql = dict(QUERIES), dict(SQL)
    for name, cuts in WHOLE.items():
        run[name] = run.pop(f"{name}_whole")
        for old, new in cuts:
            sql[name] = sql[name].replace(old, new)
    return run, sql


