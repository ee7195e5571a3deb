"""Queries over the driver's tables, one for each operator, with the SQL that gives the same rows.

Panels are made from ``events`` (user by day) and ``lineitem`` (supplier by month and day); values pass
through a logarithm, so that rounded results do not lie on rounding edges.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import cross, scalar
from .functions.windows import Series, run_length
from .operators import bars, bitemporal, evaluation, grid, histogram, market, network, prices, recursive, sets
from .plans import registry
from .sources import tables
from .sources.tables import scratch
from .streaming import increments

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
S = Series()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def r6(x: Column | str) -> Column:
    return F.round(x, 6)


# --- base tables -------------------------------------------------------------------------------

FACTS = "facts AS (SELECT CAST(ts AS DATE) AS day, user_id AS code, sum(CAST(floor(value * 100) AS BIGINT)) AS cents, count(*) AS vol, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1, 2)"
GRID = f"""WITH {FACTS},
cal AS (SELECT DISTINCT day FROM facts), uni AS (SELECT DISTINCT code FROM facts),
grid AS (SELECT u.code, c.day, ln(f.cents + 10.0) AS x, ln(f.vol + 0.5) AS y, f.vol, f.errors, row_number() OVER (PARTITION BY u.code ORDER BY c.day) AS n
         FROM uni u CROSS JOIN cal c LEFT JOIN facts f ON f.code = u.code AND f.day = c.day)
"""


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "ts", "value", "event_type")
    return e.groupBy(F.to_date("ts").alias("day"), F.col("user_id").alias("code")).agg(F.sum(F.floor(F.col("value") * 100).cast("long")).alias("cents"), F.count(F.lit(1)).alias("vol"), F.count_if(F.col("event_type") == "error").alias("errors"))


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = grid.densify(facts(spark, sf_dir))
    return dense.select("code", "day", F.log(F.col("cents") + 10.0).alias("x"), F.log(F.col("vol") + 0.5).alias("y"), "vol", "errors")


def w(n: int) -> str:
    return f"(PARTITION BY code ORDER BY day ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full_sql(expr: str, n: int, k: int, x: str = "x") -> str:
    return f"CASE WHEN n >= {n} AND count({x}) OVER {w(n)} >= {k} THEN {expr} END"


def series(name: str, column: Callable[[], Column], expr: str) -> None:
    """A query for one time-series function: (code, day, value)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return panel(spark, sf_dir).select("code", "day", r6(column()).alias("value"))

    query(name, f"{GRID} SELECT code, day, round({expr}, 6) + 0.0 AS value FROM grid")(run)


ORDER = "(PARTITION BY code ORDER BY day)"
PAIR = "CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN x END"
series("w01_shift", lambda: S.shift(F.col("x"), 3), f"lag(x, 3) OVER {ORDER}")
series("w02_pct_change", lambda: S.pct_change(F.col("x"), 2), f"(x - lag(x, 2) OVER {ORDER}) / nullif(abs(lag(x, 2) OVER {ORDER}), 0)")
series("w03_ffill", lambda: S.ffill(F.col("x")), "last_value(x IGNORE NULLS) OVER (PARTITION BY code ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
series("w04_roll_sum", lambda: S.sum(F.col("x"), 5), full_sql(f"sum(x) OVER {w(5)}", 5, 5))
series("w04_roll_mean_relaxed", lambda: S.mean(F.col("x"), 7, 3), full_sql(f"avg(x) OVER {w(7)}", 7, 3))
series("w04_roll_count", lambda: S.count(F.col("x"), 6).cast("double"), f"CASE WHEN n >= 6 THEN CAST(count(x) OVER {w(6)} AS DOUBLE) END")
series("w05_roll_var", lambda: S.var(F.col("x"), 6, 4, ddof=1), full_sql(f"var_samp(x) OVER {w(6)}", 6, 4))
series("w05_roll_std", lambda: S.std(F.col("x"), 10, 5), full_sql(f"stddev_pop(x) OVER {w(10)}", 10, 5))
series("w06_roll_cov", lambda: S.cov(F.col("x"), F.col("y"), 8, 5), full_sql(f"covar_pop(x, y) OVER {w(8)}", 8, 5, PAIR))
series("w06_roll_corr", lambda: S.corr(F.col("x"), F.col("y"), 10, 6), full_sql(f"CASE WHEN var_pop({PAIR}) OVER {w(10)} > 0 AND var_pop(CASE WHEN x IS NOT NULL THEN y END) OVER {w(10)} > 0 THEN corr(x, y) OVER {w(10)} END", 10, 6, PAIR))
series("w07_roll_skew", lambda: S.skew(F.col("x"), 12, 6), full_sql(f"CASE WHEN count(x) OVER {w(12)} >= 3 THEN skewness(x) OVER {w(12)} END", 12, 6))
series("w07_roll_kurt", lambda: S.kurt(F.col("x"), 12, 6), full_sql(f"CASE WHEN count(x) OVER {w(12)} >= 4 THEN kurtosis(x) OVER {w(12)} END", 12, 6))
series("w08_roll_max", lambda: S.max(F.col("x"), 5, 2), full_sql(f"max(x) OVER {w(5)}", 5, 2))
series("w08_roll_min", lambda: S.min(F.col("x"), 5, 2), full_sql(f"min(x) OVER {w(5)}", 5, 2))
series("w12_roll_quantile", lambda: S.quantile(F.col("x"), 10, 0.25, 5), full_sql(f"quantile_cont(x, 0.25) OVER {w(10)}", 10, 5))
series("w13_roll_product", lambda: S.product(F.col("x"), 4, 2), full_sql(f"product(coalesce(x, 1)) OVER {w(4)}", 4, 2))
series("w15_decay_linear", lambda: S.decay_linear(F.col("x"), 5), full_sql("(" + " + ".join(f"{5 - k} * lag(x, {k}) OVER {ORDER}" for k in range(5)) + ") / 15", 5, 5))
series("w16_event_decay", lambda: S.event_decay(F.col("errors").cast("double"), 5, 3.0), " + ".join(f"coalesce(lag(errors, {k}) OVER {ORDER}, 0) * pow(0.5, {k} / 3.0)" for k in range(5)))
series("w19_observed_mean", lambda: S.observed_mean(F.col("x"), 6), f"avg(x) OVER {w(6)}")
series("w20_fixed_window_mean", lambda: S.observed_mean(F.col("x"), 8, 3), f"CASE WHEN count(x) OVER {w(8)} >= 3 THEN avg(x) OVER {w(8)} END")
series("w21_past_mean", lambda: S.past_mean(F.col("x"), 5), "CASE WHEN count(x) OVER p = 5 THEN avg(x) OVER p END".replace("OVER p", "OVER (PARTITION BY code ORDER BY day ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"))
series("w21_past_std", lambda: S.past_std(F.col("x"), 6, 4), "CASE WHEN count(x) OVER p >= 4 THEN stddev_pop(x) OVER p END".replace("OVER p", "OVER (PARTITION BY code ORDER BY day ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)"))
series("w23_roll_zscore", lambda: S.zscore(F.col("x"), 10, 5), full_sql(f"CASE WHEN stddev_pop(x) OVER {w(10)} > 1e-12 THEN (x - avg(x) OVER {w(10)}) / stddev_pop(x) OVER {w(10)} END", 10, 5))
series("w24_roll_slope", lambda: S.slope(F.col("x"), F.col("y"), 12, 6), full_sql(f"CASE WHEN var_pop(CASE WHEN x IS NOT NULL THEN y END) OVER {w(12)} > 1e-18 THEN covar_pop(x, y) OVER {w(12)} / var_pop(CASE WHEN x IS NOT NULL THEN y END) OVER {w(12)} END", 12, 6, PAIR))
series("w24_residual_std", lambda: S.residual_std(F.col("x"), F.col("y"), 8), full_sql(f"CASE WHEN var_pop(y) OVER {w(8)} > 1e-18 THEN sqrt(greatest(0, var_pop(x) OVER {w(8)} - pow(covar_pop(x, y) OVER {w(8)}, 2) / var_pop(y) OVER {w(8)})) END", 8, 8, PAIR))


def _numbered(spark, sf_dir):
    return panel(spark, sf_dir).withColumn("n", S.row())


query("w09_since_max", f"{GRID} SELECT code, day, CASE WHEN n >= 6 AND count(x) OVER {w(6)} = 6 THEN CAST(6 - list_position(list(x) OVER {w(6)}, max(x) OVER {w(6)}) AS BIGINT) END AS value FROM grid")(lambda spark, d: _numbered(spark, d).select("code", "day", S.since_max(F.col("x"), 6, F.col("n")).cast("long").alias("value")))
query("w09_since_min", f"{GRID} SELECT code, day, CASE WHEN n >= 6 AND count(x) OVER {w(6)} = 6 THEN CAST(6 - list_position(list(x) OVER {w(6)}, min(x) OVER {w(6)}) AS BIGINT) END AS value FROM grid")(lambda spark, d: _numbered(spark, d).select("code", "day", S.since_min(F.col("x"), 6, F.col("n")).cast("long").alias("value")))

_SELF = "(SELECT count(*) FROM grid b WHERE b.code = a.code AND b.n BETWEEN a.n - 9 AND a.n AND b.x {op} a.x)"
query("w10_ts_rank", f"{GRID}, g AS (SELECT *, count(x) OVER {w(10)} AS k FROM grid) SELECT code, day, round(CASE WHEN n >= 10 AND k >= 5 AND x IS NOT NULL THEN {_SELF.format(op='<')} / (k - 1) END, 6) + 0.0 AS value FROM g a")(lambda spark, d: panel(spark, d).select("code", "day", r6(S.rank(F.col("x"), 10, 5)).alias("value")))
query("w11_ts_rank_average", f"{GRID}, g AS (SELECT *, count(x) OVER {w(10)} AS k FROM grid) SELECT code, day, round(CASE WHEN n >= 10 AND k = 10 THEN ({_SELF.format(op='<')} + ({_SELF.format(op='=')} + 1) / 2.0) / k END, 6) + 0.0 AS value FROM g a")(lambda spark, d: panel(spark, d).select("code", "day", r6(S.rank_average(F.col("x"), 10)).alias("value")))
_EWM = f"""{GRID.replace('WITH', 'WITH RECURSIVE', 1)}, e AS (
  SELECT code, day, n, x AS s, CASE WHEN x IS NULL THEN 0 ELSE 1 END AS seen FROM grid WHERE n = 1
  UNION ALL
  SELECT g.code, g.day, g.n, CASE WHEN g.x IS NULL THEN e.s WHEN e.s IS NULL THEN g.x ELSE e.s + 0.2 * (g.x - e.s) END, e.seen + CASE WHEN g.x IS NULL THEN 0 ELSE 1 END
  FROM e JOIN grid g ON g.code = e.code AND g.n = e.n + 1)
SELECT code, day, round(CASE WHEN seen >= 3 THEN s END, 6) + 0.0 AS value FROM e"""
query("w14_ewm", _EWM)(lambda spark, d: panel(spark, d).select("code", "day", r6(S.ewm(F.col("x"), 0.2, 3)).alias("value")))
query("w14_ewm_streamed", _EWM)(lambda spark, d: recursive.ewm(panel(spark, d).select("code", "day", "x"), "x", "value", 0.2, 3).select("code", "day", r6("value").alias("value")))
query("w17_run_length", f"""{GRID}, c AS (SELECT *, sum(CASE WHEN coalesce(x > 8, FALSE) THEN 0 ELSE 1 END) OVER (PARTITION BY code ORDER BY day ROWS UNBOUNDED PRECEDING) AS seg FROM grid)
SELECT code, day, CAST(sum(CASE WHEN coalesce(x > 8, FALSE) THEN 1 ELSE 0 END) OVER (PARTITION BY code, seg ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS value FROM c""")(lambda spark, d: run_length(panel(spark, d).withColumn("c", F.col("x") > 8), "c", "value").select("code", "day", F.col("value").cast("long").alias("value")))
query("w18_since_event", f"{GRID} SELECT code, day, CAST(n - max(CASE WHEN errors > 0 THEN n END) OVER (PARTITION BY code ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS value FROM grid")(lambda spark, d: _numbered(spark, d).select("code", "day", S.since_event(F.col("errors") > 0, F.col("n")).cast("long").alias("value")))
query("w26_autocorr", f"""{GRID}, l AS (SELECT *, lag(x) OVER {ORDER} AS x1 FROM grid), p AS (SELECT code, day, n, CASE WHEN x1 IS NOT NULL THEN x END AS a, CASE WHEN x IS NOT NULL THEN x1 END AS b FROM l)
SELECT code, day, round(CASE WHEN n >= 12 AND count(a) OVER {w(12)} >= 6 AND var_pop(a) OVER {w(12)} > 0 AND var_pop(b) OVER {w(12)} > 0 THEN corr(a, b) OVER {w(12)} END, 6) + 0.0 AS value FROM p""")(lambda spark, d: panel(spark, d).withColumn("x1", S.shift(F.col("x"))).select("code", "day", r6(S.corr(F.col("x"), F.col("x1"), 12, 6)).alias("value")))
query("w24_two_slopes", f"""{GRID}, t AS (SELECT code, day, n, x AS a, y AS b, lag(x) OVER {ORDER} AS c FROM grid),
p AS (SELECT code, day, n, CASE WHEN b IS NOT NULL AND c IS NOT NULL THEN a END AS a, CASE WHEN a IS NOT NULL AND c IS NOT NULL THEN b END AS b, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN c END AS c FROM t),
m AS (SELECT code, day, n, count(a) OVER {w(10)} AS k, var_pop(b) OVER {w(10)} AS s11, var_pop(c) OVER {w(10)} AS s22, covar_pop(b, c) OVER {w(10)} AS s12, covar_pop(b, a) OVER {w(10)} AS s1y, covar_pop(c, a) OVER {w(10)} AS s2y FROM p)
SELECT code, day, round(CASE WHEN n >= 10 AND k = 10 AND s11 * s22 - s12 * s12 > 1e-12 * s11 * s22 THEN (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) END, 5) + 0.0 AS b1 FROM m""")(lambda spark, d: panel(spark, d).withColumn("x1", S.shift(F.col("x"))).select("code", "day", F.round(S.slopes2(F.col("x"), F.col("y"), F.col("x1"), 10)[0], 5).alias("b1")))
query("w27_same_month", """WITH m AS (SELECT o_custkey % 50 AS code, year(o_orderdate) AS yr, month(o_orderdate) AS mo, sum(CAST(floor(o_totalprice) AS BIGINT)) AS v FROM orders GROUP BY ALL)
SELECT code, yr, mo, round(ln(1 + v) - avg(ln(1 + v)) OVER (PARTITION BY code, mo ORDER BY yr ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) + 0.0 AS value FROM m""")(
    lambda spark, d: table(spark, d, "orders").groupBy((F.col("o_custkey") % 50).alias("code"), F.year("o_orderdate").cast("long").alias("yr"), F.month("o_orderdate").cast("long").alias("mo")).agg(F.sum(F.floor("o_totalprice").cast("long")).alias("v"))
    .select("code", "yr", "mo", r6(F.log(1.0 + F.col("v")) - F.avg(F.log(1.0 + F.col("v"))).over(Window.partitionBy("code", "mo").orderBy("yr").rowsBetween(-3, -1))).alias("value"))
)


# --- cross-sections ----------------------------------------------------------------------------

query("r01_cs_rank", f"""{GRID}, q AS (SELECT *, quantile_cont(x, 0.01) OVER (PARTITION BY day) AS lo, quantile_cont(x, 0.99) OVER (PARTITION BY day) AS hi FROM grid),
c AS (SELECT code, day, CASE WHEN lo < hi THEN CASE WHEN x IS NOT NULL THEN least(greatest(x, lo), hi) END ELSE x END AS v FROM q),
k AS (SELECT code, day, v, count(v) OVER (PARTITION BY day) AS n, rank() OVER (PARTITION BY day ORDER BY v ASC NULLS LAST) AS lo, rank() OVER (PARTITION BY day ORDER BY v DESC NULLS LAST) AS hi FROM c)
SELECT code, day, round(CASE WHEN n >= 20 AND v IS NOT NULL THEN (lo + n - hi + 1) / 2.0 / n END, 6) + 0.0 AS value FROM k""")(lambda spark, d: cross.cs_rank(panel(spark, d), "x", "value", 20).select("code", "day", r6("value").alias("value")))
query("r02_cs_zscore", f"{GRID} SELECT code, day, round(CASE WHEN stddev_pop(x) OVER (PARTITION BY day) > 1e-12 AND x IS NOT NULL THEN least(greatest((x - avg(x) OVER (PARTITION BY day)) / stddev_pop(x) OVER (PARTITION BY day), -2), 2) END, 6) + 0.0 AS z, round(x - avg(x) OVER (PARTITION BY day), 6) + 0.0 AS demeaned FROM grid")(lambda spark, d: panel(spark, d).select("code", "day", r6(cross.zscore(F.col("x"), clip=2.0)).alias("z"), r6(cross.demean(F.col("x"))).alias("demeaned")))
query("r03_standardize", f"""{GRID}, q AS (SELECT *, quantile_cont(x, 0.01) OVER (PARTITION BY day) AS lo, quantile_cont(x, 0.99) OVER (PARTITION BY day) AS hi FROM grid),
c AS (SELECT code, day, CASE WHEN lo < hi THEN CASE WHEN x IS NOT NULL THEN least(greatest(x, lo), hi) END ELSE x END AS v FROM q)
SELECT code, day, round(CASE WHEN count(v) OVER (PARTITION BY day) >= 20 AND v IS NOT NULL AND stddev_pop(v) OVER (PARTITION BY day) > 1e-12 THEN least(greatest((v - avg(v) OVER (PARTITION BY day)) / stddev_pop(v) OVER (PARTITION BY day), -10), 10) END, 6) + 0.0 AS value FROM c""")(lambda spark, d: cross.standardize(panel(spark, d), "x", "value", 20).select("code", "day", r6("value").alias("value")))
query("r04_pct_rank", f"{GRID}, k AS (SELECT code, day, vol, count(vol) OVER (PARTITION BY day) AS n, rank() OVER (PARTITION BY day ORDER BY vol ASC NULLS LAST) AS lo, rank() OVER (PARTITION BY day ORDER BY vol DESC NULLS LAST) AS hi FROM grid) SELECT code, day, round(CASE WHEN vol IS NOT NULL THEN (lo + n - hi + 1) / 2.0 / n END, 6) + 0.0 AS value FROM k")(lambda spark, d: panel(spark, d).select("code", "day", r6(cross.pct_rank(F.col("vol"))).alias("value")))
query("r05_dense_pct_rank", f"{GRID}, k AS (SELECT code, day, vol, dense_rank() OVER (PARTITION BY day ORDER BY vol) AS r FROM grid WHERE vol IS NOT NULL) SELECT code, day, round(r / max(r) OVER (PARTITION BY day), 6) + 0.0 AS value FROM k")(lambda spark, d: panel(spark, d).where("vol is not null").select("code", "day", r6(cross.dense_pct_rank(F.col("vol"))).alias("value")))
query("r06_residual", f"""{GRID}, b AS (SELECT * FROM grid WHERE x IS NOT NULL AND y IS NOT NULL)
SELECT code, day, round(x - avg(x) OVER (PARTITION BY day) - covar_pop(x, y) OVER (PARTITION BY day) / var_pop(y) OVER (PARTITION BY day) * (y - avg(y) OVER (PARTITION BY day)), 6) + 0.0 AS value FROM b""")(lambda spark, d: panel(spark, d).where("x is not null").select("code", "day", r6(cross.residual(F.col("x"), F.col("y"))).alias("value")))
query("r06_residual2", f"""{GRID}, b AS (SELECT *, sin(CAST(code AS DOUBLE)) AS z FROM grid WHERE x IS NOT NULL),
m AS (SELECT day, avg(x) mx, avg(y) my, avg(z) mz, var_pop(y) a, var_pop(z) b, covar_pop(y, z) c, covar_pop(y, x) d, covar_pop(z, x) e FROM b GROUP BY day)
SELECT b.code, b.day, round(x - mx - (m.b * d - c * e) / (a * m.b - c * c) * (y - my) - (a * e - c * d) / (a * m.b - c * c) * (z - mz), 5) + 0.0 AS value FROM b JOIN m ON b.day = m.day""")(lambda spark, d: panel(spark, d).where("x is not null").withColumn("z", F.sin(F.col("code").cast("double"))).select("code", "day", F.round(cross.residual2(F.col("x"), F.col("y"), F.col("z")), 5).alias("value")))
query("r07_others", f"""{GRID}, b AS (SELECT * FROM grid WHERE x IS NOT NULL AND code % 7 = 0)
SELECT a.code, a.day, round((SELECT avg(x) FROM b WHERE b.day = a.day AND b.code <> a.code), 6) + 0.0 AS mean_others, round((SELECT median(x) FROM b WHERE b.day = a.day AND b.code <> a.code), 6) + 0.0 AS median_others FROM b a""")(lambda spark, d: cross.median_of_others(panel(spark, d).where("x is not null and code % 7 = 0"), "x", "m").select("code", "day", r6(cross.mean_of_others(F.col("x"))).alias("mean_others"), r6("m").alias("median_others")))
query("r08_gaussian_rank", f"""{GRID}, k AS (SELECT code, day, x, count(x) OVER (PARTITION BY day) AS n, rank() OVER (PARTITION BY day ORDER BY x) AS r FROM grid WHERE x IS NOT NULL),
p AS (SELECT code, day, (r - 0.5) / n AS p FROM k), t AS (SELECT *, sqrt(-2 * ln(least(p, 1 - p))) AS t FROM p), s AS (SELECT *, t - (2.515517 + t * (0.802853 + t * 0.010328)) / (1 + t * (1.432788 + t * (0.189269 + t * 0.001308))) AS s FROM t)
SELECT code, day, round(CASE WHEN p < 0.5 THEN -s ELSE s END, 6) + 0.0 AS value FROM s""")(lambda spark, d: panel(spark, d).where("x is not null").select("code", "day", F.rank().over(Window.partitionBy("day").orderBy("x")).alias("r"), F.count("x").over(Window.partitionBy("day")).alias("n")).select("code", "day", r6(scalar.gaussian_rank(F.col("r"), F.col("n"))).alias("value")))
query("r09_pool_relative", f"{GRID} SELECT code, day, round(x - avg(CASE WHEN code % 3 = 0 THEN x END) OVER (PARTITION BY day), 6) + 0.0 AS value FROM grid")(lambda spark, d: panel(spark, d).select("code", "day", r6(cross.pool_relative(F.col("x"), F.col("code") % 3 == 0)).alias("value")))


# --- projections and predicates ----------------------------------------------------------------

query("p01_safe_math", f"""WITH {FACTS} SELECT code, day, round(CASE WHEN abs(errors) > 0 THEN cents / errors END, 6) + 0.0 AS ratio, round(CASE WHEN cents > 5000 THEN vol / cents END, 9) + 0.0 AS floored,
 round(CASE WHEN cents - 3000 > 0 THEN ln(cents - 3000) END, 6) + 0.0 AS log_over, round(CASE WHEN cents - 3000 >= 0 THEN sqrt(cents - 3000) END, 6) + 0.0 AS root,
 round(sign(cents - 3000) * pow(abs(cents - 3000), 0.3), 6) + 0.0 AS powered, CAST(least(greatest(vol, 2), 4) AS BIGINT) AS clamped FROM facts""")(
    lambda spark, d: facts(spark, d).select("code", "day", r6(scalar.safe_div(F.col("cents"), F.col("errors"))).alias("ratio"), F.round(scalar.positive_div(F.col("vol"), F.col("cents"), 5000), 9).alias("floored"), r6(scalar.safe_log(F.col("cents") - 3000.0)).alias("log_over"), r6(scalar.safe_sqrt(F.col("cents") - 3000.0)).alias("root"), r6(scalar.signed_power(F.col("cents") - 3000.0, 0.3)).alias("powered"), scalar.clamp("vol", 2, 4).cast("long").alias("clamped"))
)
query("p08_predicates", """SELECT p_partkey, p_brand IN ('Brand#11', 'Brand#23') AS in_pool, starts_with(p_type, 'STANDARD') OR starts_with(p_type, 'SMALL') AS prefixed, CAST(floor(p_retailprice * 1.1 * 100 + 0.5) AS DOUBLE) / 100 AS limit_up,
 p_retailprice > 1000 + 1e-9 AS over FROM part""")(lambda spark, d: table(spark, d, "part").select("p_partkey", F.col("p_brand").isin("Brand#11", "Brand#23").alias("in_pool"), scalar.any_prefix("p_type", ["STANDARD", "SMALL"]).alias("prefixed"), scalar.price_limit("p_retailprice").alias("limit_up"), scalar.gt(F.col("p_retailprice"), F.lit(1000.0)).alias("over")))
query("p10_quarter_ends", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST((year(o_orderdate) - 1990) * 4 + quarter(o_orderdate) - 1 AS INTEGER) AS period FROM orders WHERE strftime(o_orderdate, '%m%d') IN ('0331', '0630', '0930', '1231')")(lambda spark, d: table(spark, d, "orders").where(scalar.quarter_end("o_orderdate")).select(F.to_date("o_orderdate").alias("day"), scalar.quarter_ordinal("o_orderdate").alias("period")).distinct())
query("p14_text_parse", """SELECT event_id, CAST(regexp_extract(props, '"k": (-?\\d+)', 1) AS BIGINT) AS k, CAST(strftime(ts, '%H%M') AS INTEGER) AS clock, CAST(CAST(ts AS DATE) AS DATE) AS day FROM events""")(lambda spark, d: table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), scalar.clock(F.date_format("ts", "HH:mm")).alias("clock"), scalar.parse_day(F.col("ts").cast("string")).alias("day")))
query("p15_universe", f"""{GRID}, u AS (SELECT code, min(day) AS a, max(day) AS b FROM facts GROUP BY code), l AS (SELECT g.*, row_number() OVER (PARTITION BY g.code ORDER BY g.day) AS age FROM grid g JOIN u ON u.code = g.code AND g.day BETWEEN u.a AND u.b)
SELECT code, day FROM l WHERE age > 5 AND NOT EXISTS (SELECT 1 FROM facts f WHERE f.code = l.code AND f.day = l.day AND f.errors > 1)""")(lambda spark, d: _universe(spark, d))


def _universe(spark, d):
    f = facts(spark, d)
    spans = f.groupBy("code").agg(F.min("day").alias("list_day"), F.max("day").alias("delist_day"))
    inside = grid.listed(panel(spark, d).select("code", "day"), spans).withColumn("age", S.row()).where("age > 5")
    return inside.join(f.where("errors > 1").select("code", "day"), ["code", "day"], "left_anti").select("code", "day")


# --- grids and joins ---------------------------------------------------------------------------

query("g01_dense_grid", f"{GRID} SELECT code, day, vol FROM grid")(lambda spark, d: panel(spark, d).select("code", "day", "vol"))
query("g04_wide", "SELECT CAST(ts AS DATE) AS day, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in ("click", "view", "error")) + " FROM events GROUP BY 1")(lambda spark, d: grid.to_wide(table(spark, d, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n")), "event_type", "n", ["day"], ["click", "view", "error"]).fillna(0))
query("g03_long", "SELECT s_suppkey, 's_nationkey' AS name, CAST(s_nationkey AS DOUBLE) AS value FROM supplier UNION ALL SELECT s_suppkey, 's_acctbal', s_acctbal FROM supplier")(lambda spark, d: grid.to_long(table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").cast("double").alias("s_nationkey"), "s_acctbal"), ["s_suppkey"], ["s_nationkey", "s_acctbal"]))
query("g07_next_session", "WITH s AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE dayofweek(l_shipdate) BETWEEN 1 AND 5) SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, (SELECT min(s.day) FROM s WHERE s.day > CAST(o.o_orderdate AS DATE)) AS next_day FROM orders o")(
    lambda spark, d: grid.next_session(table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct(), table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("day")).where("weekday(day) < 5").distinct())
)
query("g08_shift_sessions", "WITH s AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem) SELECT day, lag(day, 5) OVER (ORDER BY day) AS shifted_day FROM s")(lambda spark, d: grid.shift_sessions(table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct(), 5))
query("g09_session_runs", """WITH s AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem), k AS (SELECT day, row_number() OVER (ORDER BY day) AS n FROM s),
p AS (SELECT * FROM k WHERE day IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_suppkey % 10 = 1 AND l_returnflag = 'A')), r AS (SELECT *, n - row_number() OVER (ORDER BY n) AS g FROM p)
SELECT min(day) AS from_day, max(day) AS to_day, count(*) AS n_sessions FROM r GROUP BY g""")(lambda spark, d: grid.session_runs(table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("day")), table(spark, d, "lineitem").where("l_suppkey % 10 = 1 and l_returnflag = 'A'").select(F.to_date("l_shipdate").alias("day"))))
query("g10_month_ends", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day, count(DISTINCT CAST(o_orderdate AS DATE)) AS n_sessions FROM orders GROUP BY 1")(lambda spark, d: grid.month_ends(table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()))

_SRC = "src AS (SELECT user_id AS code, CAST(ts AS DATE) AS day, event_id AS k, CASE WHEN event_type = 'view' THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS v FROM events WHERE event_id % 3 = 0)"
_LAST = "SELECT max(struct_pack(d := s.day, k := s.k, v := s.v)) FROM src s WHERE s.code = g.code AND s.day {op} g.day"


def _source(spark, d, which="event_id % 3 = 0"):
    e = table(spark, d, "events").where(which)
    return e.select(F.col("user_id").alias("code"), F.to_date("ts").alias("day"), F.col("event_id").alias("k"), F.when(F.col("event_type") != "view", F.floor("value").cast("long")).alias("v"))


query("j01_asof", f"{GRID}, {_SRC}, a AS (SELECT g.code, g.day, ({_LAST.format(op='<=')}) AS m FROM grid g) SELECT code, day, m.v AS v, m.d AS source_day FROM a")(lambda spark, d: grid.asof(panel(spark, d).select("code", "day"), _source(spark, d), ["v"], ["k"]))
query("j01_asof_strict_aged", f"{GRID}, {_SRC}, a AS (SELECT g.code, g.day, ({_LAST.format(op='<')}) AS m FROM grid g) SELECT code, day, CASE WHEN day - m.d <= 2 THEN m.v END AS v, CASE WHEN day - m.d <= 2 THEN m.d END AS source_day FROM a")(lambda spark, d: grid.asof(panel(spark, d).select("code", "day"), _source(spark, d), ["v"], ["k"], strict=True, max_age=2))
query("j03_scatter", f"{GRID} SELECT g.code, g.day, round(coalesce((SELECT sum(CAST(floor(value) AS BIGINT)) FROM events e WHERE e.user_id = g.code AND CAST(e.ts AS DATE) = g.day AND event_type = 'purchase'), 0), 6) + 0.0 AS n FROM grid g")(lambda spark, d: grid.scatter(panel(spark, d).select("code", "day"), table(spark, d, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("code"), F.to_date("ts").alias("day"), F.floor("value").cast("double").alias("wt")), F.col("wt")))
query("j04_scatter_covered", f"{GRID}, ev AS (SELECT user_id AS code, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'error' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'), c AS (SELECT min(day) AS a, max(day) AS b FROM ev) SELECT g.code, g.day, CASE WHEN g.day BETWEEN c.a AND c.b THEN CAST((SELECT count(*) FROM ev WHERE ev.code = g.code AND ev.day = g.day) AS DOUBLE) END AS n FROM grid g, c")(lambda spark, d: grid.scatter(panel(spark, d).select("code", "day"), table(spark, d, "events").where("event_type = 'error'").select(F.col("user_id").alias("code"), F.to_date("ts").alias("day")).where("day between '2024-01-05' and '2024-01-20'"), covered=True))
query("j11_market_join", f"{GRID}, m AS (SELECT day, avg(x) AS mx FROM grid GROUP BY day) SELECT g.code, g.day, round(g.x - m.mx, 6) + 0.0 AS excess FROM grid g JOIN m ON g.day = m.day")(lambda spark, d: (lambda p: market.spread_to_entities(p, p.groupBy("day").agg(F.avg("x").alias("mx"))).select("code", "day", r6(F.col("x") - F.col("mx")).alias("excess")))(panel(spark, d)))
query("j16_crosswalk", "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")(lambda spark, d: table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "n_name", "r_name"))
query("j18_reconcile", """WITH a AS (SELECT s_suppkey AS k, s_nationkey AS v FROM supplier WHERE s_suppkey % 5 <> 0), b AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 7 = 0 THEN -1 ELSE s_nationkey END AS v FROM supplier WHERE s_suppkey % 3 <> 0)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'only_left' WHEN a.k IS NULL THEN 'only_right' ELSE 'changed' END AS difference FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.v IS DISTINCT FROM b.v""")(
    lambda spark, d: (lambda s: sets.reconcile(s.where("k % 5 <> 0"), s.where("k % 3 <> 0").withColumn("v", F.when(F.col("k") % 7 == 0, -1).otherwise(F.col("v"))), ["k"]))(table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("v")))
)


# --- reports with two times --------------------------------------------------------------------

VINTAGES = """v AS (SELECT o_custkey % 60 AS code, (year(o_orderdate) - 1990) * 4 + quarter(o_orderdate) - 1 AS period, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 200 AS INTEGER) AS pit, max(CAST(floor(o_totalprice) AS BIGINT)) AS val FROM orders GROUP BY 1, 2, 3)"""
FRONT = """f AS (SELECT code, pit, max(mx) AS period FROM (SELECT code, pit, max(period) OVER (PARTITION BY code ORDER BY pit, period ROWS UNBOUNDED PRECEDING) AS mx FROM v) GROUP BY code, pit)"""


def vintages(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy((F.col("o_custkey") % 60).alias("code"), scalar.quarter_ordinal("o_orderdate").alias("period"), F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 200).cast("int")).alias("pit")).agg(F.max(F.floor("o_totalprice").cast("long")).alias("val"))


def at_sql(lag: int, who: str = "f") -> str:
    return f"(SELECT max(struct_pack(p := v.pit, x := v.val)).x FROM v WHERE v.code = {who}.code AND v.period = {who}.period - {lag} AND v.pit <= {who}.pit)"


query("j05_value_at_period", f"WITH {VINTAGES}, {FRONT} SELECT code, pit, CAST(period AS INTEGER) AS period, {at_sql(0)} AS now, {at_sql(4)} AS year_ago FROM f")(lambda spark, d: (lambda v: bitemporal.at_period(bitemporal.at_period(bitemporal.revision_events(v), v, "val", "now"), v, "val", "year_ago", 4).select("code", "pit", "period", "now", "year_ago"))(vintages(spark, d)))
query("j06_frontier", f"WITH {VINTAGES}, m AS (SELECT *, max(period) OVER (PARTITION BY code ORDER BY pit, period ROWS UNBOUNDED PRECEDING) AS mx FROM v) SELECT code, pit, CAST(period AS INTEGER) AS period, val FROM m WHERE period = mx QUALIFY row_number() OVER (PARTITION BY code, pit ORDER BY period DESC) = 1")(lambda spark, d: bitemporal.frontier(vintages(spark, d)).select("code", "pit", "period", "val"))
query("j07_revision_events", f"WITH {VINTAGES}, {FRONT} SELECT code, pit, CAST(period AS INTEGER) AS period FROM f")(lambda spark, d: bitemporal.revision_events(vintages(spark, d)))
query("j08_merge_sources", f"WITH {VINTAGES}, a AS (SELECT code, period, pit, val AS a FROM v WHERE val % 2 = 0), b AS (SELECT code, period, pit, val AS b FROM v WHERE val % 3 = 0) SELECT coalesce(a.code, b.code) AS code, CAST(coalesce(a.period, b.period) AS INTEGER) AS period, coalesce(a.pit, b.pit) AS pit, a, b FROM a FULL JOIN b ON a.code = b.code AND a.period = b.period AND a.pit = b.pit")(lambda spark, d: (lambda v: bitemporal.merge_sources([v.where("val % 2 = 0").withColumnRenamed("val", "a"), v.where("val % 3 = 0").withColumnRenamed("val", "b")]))(vintages(spark, d)))
query("j09_first_vintage", f"WITH {VINTAGES} SELECT code, CAST(period AS INTEGER) AS period, pit, val FROM v QUALIFY row_number() OVER (PARTITION BY code, period ORDER BY pit) = 1")(lambda spark, d: bitemporal.first_vintage(vintages(spark, d)))
_C = ", ".join(f"{at_sql(k)} AS c{k}" for k in range(8))
_TTM = f"""WITH {VINTAGES}, {FRONT}, c AS (SELECT code, pit, period, period % 4 AS q, {_C} FROM f),
t AS (SELECT *, CASE WHEN q = 3 THEN c0 ELSE c0 + CASE q WHEN 0 THEN c1 WHEN 1 THEN c2 WHEN 2 THEN c3 END - c4 END AS three FROM c)"""
_SINGLES = " + ".join(f"CASE WHEN (period - {k}) % 4 = 0 THEN c{k} ELSE c{k} - c{k + 1} END" for k in range(4))
query("f01_trailing_year", f"{_TTM} SELECT code, pit, CAST(period AS INTEGER) AS period, coalesce(three, {_SINGLES}) AS value FROM t")(lambda spark, d: (lambda v: bitemporal.trailing_year(bitemporal.revision_events(v), v, "val", "value").select("code", "pit", "period", "value"))(vintages(spark, d)))
query("f02_trailing_year_strict", f"{_TTM} SELECT code, pit, CAST(period AS INTEGER) AS period, three AS value FROM t")(lambda spark, d: (lambda v: bitemporal.trailing_year(bitemporal.revision_events(v), v, "val", "value", strict=True).select("code", "pit", "period", "value"))(vintages(spark, d)))
query("f04_single_quarter", f"WITH {VINTAGES}, {FRONT} SELECT code, pit, CAST(period AS INTEGER) AS period, CASE WHEN period % 4 = 0 THEN {at_sql(0)} ELSE {at_sql(0)} - {at_sql(1)} END AS value FROM f")(lambda spark, d: (lambda v: bitemporal.single_quarter(bitemporal.revision_events(v), v, "val", "value").select("code", "pit", "period", "value"))(vintages(spark, d)))
query("f07_two_newest_periods", f"""WITH {VINTAGES}, p AS (SELECT DISTINCT code, pit FROM v), n AS (SELECT p.*, (SELECT max(period) FROM v WHERE v.code = p.code AND v.pit <= p.pit) AS newest FROM p),
m AS (SELECT n.*, (SELECT max(period) FROM v WHERE v.code = n.code AND v.pit <= n.pit AND v.period < n.newest) AS previous FROM n)
SELECT code, pit, CAST(newest AS INTEGER) AS newest, CAST(previous AS INTEGER) AS previous, (SELECT max(struct_pack(a := pit, b := val)).b FROM v WHERE v.code = m.code AND v.period = m.newest AND v.pit <= m.pit) AS value, (SELECT max(struct_pack(a := pit, b := val)).b FROM v WHERE v.code = m.code AND v.period = m.previous AND v.pit <= m.pit) AS previous_value FROM m""")(lambda spark, d: bitemporal.two_newest_periods(vintages(spark, d), "val"))
query("f08_surprise", f"""WITH {VINTAGES}, q AS (SELECT code, period, ln(val + 1.0) AS val FROM v QUALIFY row_number() OVER (PARTITION BY code, period ORDER BY pit) = 1),
s AS (SELECT *, CASE WHEN lag(period, 4) OVER w = period - 4 THEN val - lag(val, 4) OVER w END AS diff FROM q WINDOW w AS (PARTITION BY code ORDER BY period))
SELECT code, CAST(period AS INTEGER) AS period, round(CASE WHEN count(diff) OVER w >= 6 AND stddev_samp(diff) OVER w > 1e-12 THEN diff / stddev_samp(diff) OVER w END, 6) + 0.0 AS value FROM s WINDOW w AS (PARTITION BY code ORDER BY period ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)""")(lambda spark, d: bitemporal.surprise(bitemporal.first_vintage(vintages(spark, d)).withColumn("val", F.log(F.col("val") + 1.0)), "val", "value").select("code", "period", r6("value").alias("value")))


# --- intraday bars -----------------------------------------------------------------------------

BARS = """bars AS (SELECT user_id % 40 AS code, CAST(ts AS DATE) AS day, hour(ts) AS hr, event_id, CAST(floor(value * 100) + 50 AS DOUBLE) / 100 AS close, CAST(floor(value * 90) + 50 AS DOUBLE) / 100 AS open, CAST(floor(value * 110) + 60 AS DOUBLE) / 100 AS high, CAST(floor(value * 80) + 30 AS DOUBLE) / 100 AS low, CAST(1 + user_id % 9 + event_id % 17 AS BIGINT) AS vol FROM events),
b AS (SELECT *, row_number() OVER w - 1 AS slot, lag(close) OVER w AS previous, count(*) OVER (PARTITION BY code, day) AS n_slots, close / lag(close) OVER w - 1 AS r FROM bars WINDOW w AS (PARTITION BY code, day ORDER BY event_id))"""


def raw_bars(spark, d):
    cents = lambda f, a: ((F.floor(F.col("value") * f) + a).cast("double") / 100)
    e = table(spark, d, "events")
    return e.select((F.col("user_id") % 40).alias("code"), F.to_date("ts").alias("day"), F.hour("ts").alias("hr"), "event_id", cents(100, 50).alias("close"), cents(90, 50).alias("open"), cents(110, 60).alias("high"), cents(80, 30).alias("low"), (1 + F.col("user_id") % 9 + F.col("event_id") % 17).alias("vol")).withColumn("amount", F.col("vol") * F.col("close"))


def day_bars(spark, d):
    return bars.number_bars(raw_bars(spark, d), ["event_id"])


query("a01_daily_bars", f"""WITH {BARS} SELECT code, day, arg_min(open, slot) AS open, arg_max(close, slot) AS close, max(high) AS high, min(low) AS low, CAST(sum(vol) AS BIGINT) AS vol, count(*) AS n_bars,
 round(coalesce(sum(r), 0), 4) + 0.0 AS sum_r, round(coalesce(sum(abs(r)), 0), 4) + 0.0 AS sum_abs_r, round(coalesce(sum(r * r) FILTER (WHERE r > 0), 0), 3) + 0.0 AS sum_up_r2, round(coalesce(sum(r * r) FILTER (WHERE r < 0), 0), 6) + 0.0 AS sum_down_r2, count(*) FILTER (WHERE r > 0) AS n_up, count(*) FILTER (WHERE r = 0) AS n_flat FROM b GROUP BY code, day""")(
    lambda spark, d: bars.daily(day_bars(spark, d)).select("code", "day", "open", "close", "high", "low", "vol", "n_bars", F.round("sum_r", 4).alias("sum_r"), F.round("sum_abs_r", 4).alias("sum_abs_r"), F.round("sum_up_r2", 3).alias("sum_up_r2"), r6("sum_down_r2").alias("sum_down_r2"), "n_up", "n_flat")
)
query("a03_extreme_places", f"WITH {BARS}, m AS (SELECT code, day, max(high) AS hi, min(low) AS lo, greatest(max(slot), 1) AS s FROM b GROUP BY ALL) SELECT b.code, b.day, round(min(slot) FILTER (WHERE high = hi) / any_value(s), 6) + 0.0 AS high_place, round(min(slot) FILTER (WHERE low = lo) / any_value(s), 6) + 0.0 AS low_place FROM b JOIN m ON b.code = m.code AND b.day = m.day GROUP BY b.code, b.day")(lambda spark, d: bars.extreme_places(day_bars(spark, d)).select("code", "day", r6("high_place").alias("high_place"), r6("low_place").alias("low_place")))
query("a04_path", f"WITH {BARS}, m AS (SELECT code, day, close / max(close) OVER w - 1 AS f, close / min(close) OVER w - 1 AS u FROM b WINDOW w AS (PARTITION BY code, day ORDER BY slot ROWS UNBOUNDED PRECEDING)) SELECT code, day, round(min(f), 9) + 0.0 AS max_drawdown, round(max(u), 9) + 0.0 AS max_runup FROM m GROUP BY ALL")(lambda spark, d: bars.path(day_bars(spark, d)).select("code", "day", F.round("max_drawdown", 9).alias("max_drawdown"), F.round("max_runup", 9).alias("max_runup")))
query("a06_sessions", f"WITH {BARS} SELECT code, day, CAST(sum(vol) FILTER (WHERE hr < 12) AS BIGINT) AS am_vol, round(arg_max(close, slot) FILTER (WHERE hr < 12) / arg_min(open, slot) FILTER (WHERE hr < 12) - 1, 9) + 0.0 AS am_ret, CAST(sum(vol) FILTER (WHERE hr >= 12) AS BIGINT) AS pm_vol, round(coalesce(sum(vol) FILTER (WHERE hr < 12), 0) / sum(vol), 6) + 0.0 AS am_share FROM b GROUP BY ALL")(lambda spark, d: bars.sessions(day_bars(spark, d), F.col("hr") < 12, F.col("hr") >= 12).select("code", "day", "am_vol", F.round("am_ret", 9).alias("am_ret"), "pm_vol", r6("am_share").alias("am_share")))
query("a08_complete", "WITH h AS (SELECT user_id % 3 AS code, CAST(ts AS DATE) AS day, hour(ts) AS hr FROM events) SELECT code, day, count(*) AS n_bars, count(*) = 24 AND count(DISTINCT hr) = 24 AS is_complete FROM (SELECT DISTINCT * FROM h) GROUP BY ALL")(lambda spark, d: bars.complete(table(spark, d, "events").select((F.col("user_id") % 3).alias("code"), F.to_date("ts").alias("day"), F.hour("ts").alias("hr")).distinct(), "hr", list(range(24))))
query("a09_tail_bars", f"WITH {BARS} SELECT code, day, CAST(sum(vol) FILTER (WHERE slot >= n_slots - 3) AS BIGINT) AS tail_vol, round(arg_max(close, slot) FILTER (WHERE slot >= n_slots - 3) / arg_min(open, slot) FILTER (WHERE slot >= n_slots - 3) - 1, 9) + 0.0 AS tail_ret, round(sum(vol) FILTER (WHERE slot >= n_slots - 3) / sum(vol), 6) + 0.0 AS tail_share FROM b GROUP BY ALL")(lambda spark, d: bars.edge(day_bars(spark, d), 3, head=False).select("code", "day", "tail_vol", F.round("tail_ret", 9).alias("tail_ret"), r6("tail_share").alias("tail_share")))
query("t04_top_bars", f"WITH {BARS}, s AS (SELECT *, row_number() OVER (PARTITION BY code, day ORDER BY abs(r) / sqrt(vol) DESC NULLS LAST, slot) AS k FROM b) SELECT code, day, round(coalesce(sum(vol) FILTER (WHERE k <= 3 AND r IS NOT NULL), 0) / sum(vol), 6) + 0.0 AS top_share FROM s GROUP BY ALL")(lambda spark, d: bars.top_bars(day_bars(spark, d), 3).select("code", "day", r6("top_share").alias("top_share")))


# --- histograms --------------------------------------------------------------------------------

LEVELS = """levels AS (SELECT l_suppkey AS code, CAST(date_trunc('year', l_shipdate) AS DATE) AS day, CAST(floor(l_extendedprice / l_quantity / 100) AS DOUBLE) AS price, CAST(l_quantity AS DOUBLE) AS weight FROM lineitem),
s AS (SELECT code, day, price, sum(weight) AS weight FROM levels WHERE weight > 0 AND price > 0 GROUP BY ALL), n AS (SELECT *, weight / sum(weight) OVER (PARTITION BY code, day) AS w FROM s),
c AS (SELECT *, sum(w) OVER (PARTITION BY code, day ORDER BY price ROWS UNBOUNDED PRECEDING) AS cum FROM n)"""


def levels(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("code"), F.trunc("l_shipdate", "year").alias("day"), F.floor(F.col("l_extendedprice") / F.col("l_quantity") / 100).cast("double").alias("price"), F.col("l_quantity").cast("double").alias("weight"))


query("a10_moments", f"""WITH {LEVELS}, m AS (SELECT *, sum(w * price) OVER (PARTITION BY code, day) AS mu FROM n), k AS (SELECT code, day, max(mu) AS mean, sum(w * (price - mu) ** 2) AS var, sum(w * (price - mu) ** 3) AS m3, sum(w * (price - mu) ** 4) AS m4, count(*) AS n_levels FROM m GROUP BY ALL)
SELECT code, day, round(mean, 5) + 0.0 AS mean, round(var, 4) + 0.0 AS var, round(CASE WHEN var > 1e-12 THEN m3 / pow(var, 1.5) END, 5) + 0.0 AS skew, round(CASE WHEN var > 1e-12 THEN m4 / (var * var) END, 5) + 0.0 AS kurt, n_levels FROM k""")(lambda spark, d: histogram.moments(levels(spark, d)).select("code", "day", F.round("mean", 5).alias("mean"), F.round("var", 4).alias("var"), F.round("skew", 5).alias("skew"), F.round("kurt", 5).alias("kurt"), "n_levels"))
query("a10_quantiles", f"""WITH {LEVELS}, p AS (SELECT *, lag(cum) OVER (PARTITION BY code, day ORDER BY price) AS c0, lag(price) OVER (PARTITION BY code, day ORDER BY price) AS p0 FROM c)
SELECT code, day, {", ".join(f"round(coalesce(min(CASE WHEN cum >= {q} AND coalesce(c0, -1) < {q} THEN CASE WHEN c0 IS NULL THEN price ELSE p0 + ({q} - c0) / (cum - c0) * (price - p0) END END), max(price)), 5) + 0.0 AS q{round(q * 100):02d}" for q in (0.1, 0.5, 0.9))} FROM p GROUP BY ALL""")(lambda spark, d: histogram.quantiles(levels(spark, d), [0.1, 0.5, 0.9]).select("code", "day", *[F.round(c, 5).alias(c) for c in ("q10", "q50", "q90")]))
query("a10_concentration", f"""WITH {LEVELS}, r AS (SELECT *, row_number() OVER (PARTITION BY code, day ORDER BY w DESC, price) AS h, row_number() OVER (PARTITION BY code, day ORDER BY w, price DESC) AS l, count(*) OVER (PARTITION BY code, day) AS k FROM n)
SELECT code, day, round(sum(w) FILTER (WHERE h <= 3), 6) + 0.0 AS top_share, round(sum(w * w), 6) + 0.0 AS hhi, round(-sum(w * ln(w)), 6) + 0.0 AS entropy, round(sum((2 * l - k - 1) * w) / max(k), 6) + 0.0 AS gini, max(price) FILTER (WHERE h = 1) AS mode FROM r GROUP BY ALL""")(lambda spark, d: histogram.concentration(levels(spark, d)).select("code", "day", *[r6(c).alias(c) for c in ("top_share", "hhi", "entropy", "gini")], "mode"))
query("a10_peaks", f"WITH {LEVELS}, p AS (SELECT code, day, w, coalesce(lag(w) OVER q, 0) AS a, coalesce(lead(w) OVER q, 0) AS b FROM n WINDOW q AS (PARTITION BY code, day ORDER BY price)) SELECT code, day, count(*) FILTER (WHERE w > a AND w > b) AS n_peaks FROM p GROUP BY ALL")(lambda spark, d: histogram.peaks(levels(spark, d)))
_CLOSE = "k AS (SELECT code, day, CAST(floor(avg(price)) AS DOUBLE) + 0.5 AS close FROM s GROUP BY ALL)"


def closes(lv):
    return lv.where("price > 0").select("code", "day", "price").distinct().groupBy("code", "day").agg((F.floor(F.avg("price")).cast("double") + 0.5).alias("close"))


query("a11_around_close", f"WITH {LEVELS}, {_CLOSE} SELECT n.code, n.day, round(coalesce(sum(w) FILTER (WHERE price < close), 0), 6) + 0.0 AS below, round(coalesce(sum(w) FILTER (WHERE price > close), 0), 6) + 0.0 AS above, round(coalesce(sum(w) FILTER (WHERE price > close AND price <= close * (1 + 0.05)), 0), 6) + 0.0 AS near_above, round(sum(w * (price / close - 1)), 6) + 0.0 AS mean_gap, round(sqrt(coalesce(sum(w * (price / close - 1) ** 2) FILTER (WHERE price < close), 0)), 6) + 0.0 AS semi_deviation FROM n JOIN k ON n.code = k.code AND n.day = k.day GROUP BY n.code, n.day")(lambda spark, d: (lambda lv: histogram.around(lv, closes(lv)).select("code", "day", *[r6(c).alias(c) for c in ("below", "above", "near_above", "mean_gap", "semi_deviation")]))(levels(spark, d)))
query("a13_tail_mean", f"WITH {LEVELS} SELECT code, day, round(sum(greatest(0, least(w, 0.1 - (cum - w))) * price) / sum(greatest(0, least(w, 0.1 - (cum - w)))), 5) + 0.0 AS tail_mean FROM c GROUP BY ALL")(lambda spark, d: histogram.tail_mean(levels(spark, d)).select("code", "day", F.round("tail_mean", 5).alias("tail_mean")))
query("a12_l_moments", f"WITH {LEVELS} SELECT code, day, round(sum(w * price), 5) + 0.0 AS l1, round(sum(w * price * (2 * cum - w - 1)), 5) + 0.0 AS l2 FROM c GROUP BY ALL")(lambda spark, d: histogram.l_moments(levels(spark, d)).select("code", "day", F.round("l1", 5).alias("l1"), F.round("l2", 5).alias("l2")))
query("a12_shortest_half", f"WITH {LEVELS} SELECT a.code, a.day, min(b.price - a.price) AS half_width FROM c a JOIN c b ON a.code = b.code AND a.day = b.day AND b.price >= a.price AND b.cum - (a.cum - a.w) >= 0.5 - 1e-12 GROUP BY a.code, a.day")(lambda spark, d: histogram.shortest_half(levels(spark, d)))


# --- market aggregates -------------------------------------------------------------------------

query("a14_cross_section", f"{GRID} SELECT day, count(x) AS n, round(avg(x), 6) + 0.0 AS mean, round(stddev_pop(x), 6) + 0.0 AS std, round(quantile_cont(x, 0.5), 6) + 0.0 AS median, round(quantile_cont(x, 0.75) - quantile_cont(x, 0.25), 6) + 0.0 AS iqr FROM grid GROUP BY day")(lambda spark, d: market.cross_section(panel(spark, d), "x", 1).select("day", "n", *[r6(c).alias(c) for c in ("mean", "std", "median", "iqr")]))
query("a15_share", f"{GRID} SELECT day, round(CASE WHEN count(x) >= 20 THEN count(*) FILTER (WHERE x > 9) / count(x) END, 6) + 0.0 AS value FROM grid GROUP BY day")(lambda spark, d: market.share(panel(spark, d), F.col("x") > 9, F.col("x").isNotNull(), "value", 20).select("day", r6("value").alias("value")))
query("a16_sum_if_enough", f"{GRID} SELECT day, CAST(CASE WHEN count(vol) >= 100 THEN sum(vol) END AS BIGINT) AS value FROM grid GROUP BY day")(lambda spark, d: market.sum_if_enough(panel(spark, d), "vol", 100, "value"))
query("a17_group_median", "SELECT l_suppkey, l_returnflag, median(l_quantity) AS med FROM lineitem GROUP BY ALL")(lambda spark, d: market.group_median(table(spark, d, "lineitem"), ["l_suppkey", "l_returnflag"], "l_quantity", "med"))
query("a18_distinct_count", "SELECT l_suppkey, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY ALL")(lambda spark, d: market.distinct_count(table(spark, d, "lineitem"), ["l_suppkey"], "l_partkey", "n"))
query("a19_concentration", "WITH b AS (SELECT l_returnflag, l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY ALL), p AS (SELECT *, q / sum(q) OVER (PARTITION BY l_returnflag) AS p FROM b) SELECT l_returnflag, round(sum(p * p), 9) + 0.0 AS hhi, count(*) AS n_names FROM p GROUP BY ALL")(lambda spark, d: market.concentration(table(spark, d, "lineitem"), ["l_returnflag"], "l_suppkey", "l_quantity").select("l_returnflag", F.round("hhi", 9).alias("hhi"), "n_names"))
query("a20_mode", "SELECT o_custkey, o_orderpriority AS mode, n FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) = 1")(lambda spark, d: market.mode(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority"))
query("a20_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY ALL")(lambda spark, d: market.value_counts(table(spark, d, "events"), "event_type"))
query("a21_collapse_week", "SELECT o_custkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS period, max(o_orderkey) AS o_orderkey FROM (SELECT *, rank() OVER (PARTITION BY o_custkey, date_trunc('week', o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1 GROUP BY ALL")(lambda spark, d: (lambda o: sets.collapse_periods(sets.keep_last(o, ["o_custkey", "day"], ["o_orderkey"]), "week", ["o_custkey"]).select("o_custkey", "period", "o_orderkey"))(table(spark, d, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))))
query("a22_fingerprint", "SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n_rows, CAST(sum(CAST(concat('0x', substr(md5(concat_ws(chr(31), strftime(l_shipdate, '%Y-%m-%d'), CAST(l_linenumber AS VARCHAR), CAST(l_orderkey AS VARCHAR))), 1, 12)) AS BIGINT)) AS VARCHAR) AS hash_sum FROM lineitem GROUP BY 1")(lambda spark, d: sets.fingerprint(table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("day"), F.col("l_linenumber").alias("line"), F.col("l_orderkey").alias("order_key")), ["day"]).select("day", "n_rows", F.col("hash_sum").cast("string").alias("hash_sum")))


# --- sets and intervals ------------------------------------------------------------------------

query("s12_keep_last", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")(lambda spark, d: sets.keep_last(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice"))
_SPANS = "spans AS (SELECT o_custkey % 100 AS code, CAST(o_orderdate AS DATE) AS from_day, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) AS to_day FROM orders WHERE o_orderkey % 10 = 0)"
_MERGED = f"""{_SPANS}, a AS (SELECT *, CASE WHEN from_day > max(to_day) OVER (PARTITION BY code ORDER BY from_day, to_day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 1 ELSE 0 END AS fresh FROM spans),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY code ORDER BY from_day, to_day ROWS UNBOUNDED PRECEDING) AS g FROM a), m AS (SELECT code, min(from_day) AS from_day, max(to_day) AS to_day FROM g GROUP BY code, g)"""


def spans(spark, d):
    return _spans(table(spark, d, "orders").where("o_orderkey % 10 = 0"), F.col("o_custkey") % 100)


def _spans(orders, code):
    return orders.select(code.alias("code"), F.to_date("o_orderdate").alias("from_day"), F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 20).cast("int")).alias("to_day"))


query("s20_merge_intervals", f"WITH {_MERGED} SELECT code, from_day, to_day FROM m")(lambda spark, d: sets.merge_intervals(spans(spark, d), ["code"]))
query("s20_missing_intervals", f"""WITH {_MERGED}, i AS (SELECT * FROM m WHERE to_day >= DATE '1997-01-01' AND from_day <= DATE '1998-12-31'), x AS (
 SELECT code, coalesce(lag(to_day) OVER (PARTITION BY code ORDER BY from_day) + 1, DATE '1997-01-01') AS gap_from, from_day - 1 AS gap_to FROM i UNION ALL SELECT code, max(to_day) + 1, DATE '1998-12-31' FROM i GROUP BY code)
SELECT code, gap_from, gap_to FROM x WHERE gap_from <= gap_to""")(lambda spark, d: sets.missing_intervals(spans(spark, d), ["code"], "1997-01-01", "1998-12-31"))
query("s13_replace_days", "SELECT CAST(ts AS DATE) AS day, event_id, CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' THEN 1 ELSE 0 END AS v FROM events WHERE event_id % 2 = 0 AND CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-25'")(
    lambda spark, d: (lambda e: tables.replace_days(e.withColumn("v", F.lit(0)), e.where("day between '2024-01-10' and '2024-01-12'").withColumn("v", F.lit(1)), e.where("day between '2024-01-10' and '2024-01-12'"), before="2024-01-25", after="2024-01-03"))(table(spark, d, "events").where("event_id % 2 = 0").select(F.to_date("ts").alias("day"), "event_id"))
)
query("s12_upsert", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN -s_acctbal ELSE s_acctbal END AS bal FROM supplier")(lambda spark, d: (lambda s: tables.upsert(s, s.where("s_suppkey % 3 = 0").withColumn("bal", -F.col("bal")), ["s_suppkey"], ["s_suppkey"]))(table(spark, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("bal"))))
query("s04_cutoff_scan", "SELECT o_orderkey FROM orders WHERE greatest(o_orderdate, o_orderdate + INTERVAL 30 DAY) <= TIMESTAMP '1998-06-30'")(lambda spark, d: tables.as_of_cutoff(table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("a"), F.date_add(F.to_date("o_orderdate"), 30).alias("b")), tables.Dataset("orders", ("o_orderkey",), visible=("a", "b")), "1998-06-30").select("o_orderkey"))
query("s05_watermark", "SELECT count(*) AS n_rows, max(l_shipdate) AS max_day, min(l_shipdate) AS min_day FROM lineitem")(lambda spark, d: tables.watermark(table(spark, d, "lineitem"), "l_shipdate"))
query("s06_day_counts", "SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n_rows FROM lineitem GROUP BY 1")(lambda spark, d: tables.days_of(table(spark, d, "lineitem"), "l_shipdate"))
query("s20_profile", "SELECT * FROM (SELECT 'c_custkey' AS name, count(*) AS n_rows, count(*) - count(c_custkey) AS n_null, count(DISTINCT c_custkey) AS n_distinct, CAST(min(c_custkey) AS VARCHAR) AS low, CAST(max(c_custkey) AS VARCHAR) AS high FROM customer UNION ALL SELECT 'c_mktsegment', count(*), count(*) - count(c_mktsegment), count(DISTINCT c_mktsegment), min(c_mktsegment), max(c_mktsegment) FROM customer)")(lambda spark, d: tables.profile(table(spark, d, "customer").select("c_custkey", "c_mktsegment")))
query("s20_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")(lambda spark, d: tables.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]))
query("s10_unpack_dump", "SELECT CAST(user_id AS VARCHAR) AS code, CAST(event_id AS VARCHAR) AS time, value AS close FROM events WHERE event_id % 50 = 0")(
    lambda spark, d: tables.unpack_dump(table(spark, d, "events").where("event_id % 50 = 0").select(F.to_json(F.create_map(F.col("user_id").cast("string"), F.array(F.array(F.col("event_id").cast("string"), F.lit("1"), F.lit("2"), F.lit("0"), F.col("value").cast("string"), F.lit("7"), F.lit("8"))))).alias("dump"))).select("code", "time", "close")
)
query("s17_magnitude_jumps", f"WITH {FACTS}, m AS (SELECT day, quantile_cont(CASE WHEN day = DATE '2024-01-15' THEN cents * 100 ELSE cents END, 0.5) AS median FROM facts GROUP BY day), r AS (SELECT *, median / lag(median) OVER (ORDER BY day) AS ratio FROM m) SELECT day, round(ratio, 6) + 0.0 AS ratio FROM r WHERE ratio >= 5 OR ratio <= 0.2")(lambda spark, d: tables.magnitude_jumps(facts(spark, d).withColumn("cents", F.when(F.col("day") == F.lit("2024-01-15").cast("date"), F.col("cents") * 100).otherwise(F.col("cents"))), "cents").select("day", r6("ratio").alias("ratio")))


# The SQL of these compares a part of its rows; beside it, they run over whole tables, without SQL.


def replaced_days(e):
    fresh = e.where("day between '2024-01-10' and '2024-01-12'")
    return tables.replace_days(e.withColumn("v", F.lit(0)), fresh.withColumn("v", F.lit(1)), fresh, before="2024-01-25", after="2024-01-03")


def dumps(e):
    return e.select(F.to_json(F.create_map(F.col("user_id").cast("string"), F.array(F.array(F.col("event_id").cast("string"), F.lit("1"), F.lit("2"), F.lit("0"), F.col("value").cast("string"), F.lit("7"), F.lit("8"))))).alias("dump"))


query("s20_merge_intervals_whole")(lambda spark, d: sets.merge_intervals(_spans(table(spark, d, "orders"), F.col("o_custkey")), ["code"]))
query("s20_missing_intervals_whole")(lambda spark, d: sets.missing_intervals(_spans(table(spark, d, "orders"), F.col("o_custkey")), ["code"], "1997-01-01", "1998-12-31"))
query("s13_replace_days_whole")(lambda spark, d: replaced_days(table(spark, d, "events").select(F.to_date("ts").alias("day"), "event_id")))
query("s10_unpack_dump_whole")(lambda spark, d: tables.unpack_dump(dumps(table(spark, d, "events"))).select("code", "time", "close"))
query("j01_asof_whole")(lambda spark, d: grid.asof(panel(spark, d).select("code", "day"), _source(spark, d, "true"), ["v"], ["k"]))
query("j01_asof_strict_aged_whole")(lambda spark, d: grid.asof(panel(spark, d).select("code", "day"), _source(spark, d, "true"), ["v"], ["k"], strict=True, max_age=2))
query("r07_others_whole")(lambda spark, d: cross.median_of_others(panel(spark, d).where("x is not null"), "x", "m").select("code", "day", r6(cross.mean_of_others(F.col("x"))).alias("mean_others"), r6("m").alias("median_others")))
query("g09_session_runs_whole")(lambda spark, d: grid.session_runs(table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("day")), table(spark, d, "lineitem").where("l_returnflag = 'A'").select(F.to_date("l_shipdate").alias("day"))))


# --- networks ----------------------------------------------------------------------------------

PAIRS = f"""{GRID}, s AS (SELECT code, day, x FROM grid WHERE code < 40 AND x IS NOT NULL),
pairs AS (SELECT a.code AS i, b.code AS j, corr(a.x, b.x) AS corr, count(*) AS n FROM s a JOIN s b ON a.day = b.day AND a.code < b.code GROUP BY ALL HAVING count(*) >= 10 AND stddev_pop(a.x) > 1e-12 AND stddev_pop(b.x) > 1e-12),
twoway AS (SELECT i, j, corr FROM pairs UNION ALL SELECT j, i, corr FROM pairs),
edges AS (SELECT * FROM twoway QUALIFY row_number() OVER (PARTITION BY i ORDER BY abs(round(corr, 9)) DESC, j) <= 5)"""


def small(spark, d):
    return panel(spark, d).where("code < 40")


def edges_of(spark, d):
    return network.nearest(small(spark, d), "x", 10, 5)


query("n01_pair_correlations", f"{PAIRS} SELECT i, j, round(corr, 6) + 0.0 AS corr, n FROM pairs")(lambda spark, d: network.pair_correlations(small(spark, d), "x", 10).select("i", "j", r6("corr").alias("corr"), "n"))
query("n02_neighbours", f"{PAIRS} SELECT i, j, round(corr, 6) + 0.0 AS corr FROM edges")(lambda spark, d: edges_of(spark, d).select("i", "j", r6("corr").alias("corr")))
query("n03_peer_stats", f"{PAIRS} SELECT e.i AS code, s.day, count(*) AS n_peers, round(sum(abs(corr) * x) / sum(abs(corr)), 6) + 0.0 AS peer_mean, round(avg(CASE WHEN x > 0 THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS peer_up, round(stddev_pop(x), 6) + 0.0 AS peer_std FROM edges e JOIN s ON s.code = e.j GROUP BY ALL")(lambda spark, d: network.peer_stats(edges_of(spark, d), small(spark, d), "x").select("code", "day", "n_peers", *[r6(c).alias(c) for c in ("peer_mean", "peer_up", "peer_std")]))
query("n04_tightness", f"{PAIRS}, p AS (SELECT a.i, a.j, b.j AS k FROM edges a JOIN edges b ON a.i = b.i AND a.j < b.j) SELECT p.i, round(avg(CASE WHEN EXISTS (SELECT 1 FROM edges e WHERE (e.i = p.j AND e.j = p.k) OR (e.i = p.k AND e.j = p.j)) THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS tightness FROM p GROUP BY p.i")(lambda spark, d: network.tightness(edges_of(spark, d)).select("i", r6("tightness").alias("tightness")))
query("n04_two_hop", f"{PAIRS}, f AS (SELECT DISTINCT a.i, b.j AS k FROM edges a JOIN edges b ON a.j = b.i WHERE a.i <> b.j) SELECT i, count(*) AS n_two_hop FROM f WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.i = f.i AND e.j = f.k) GROUP BY i")(lambda spark, d: network.two_hop(edges_of(spark, d)))
query("n05_eigen_centrality")(lambda spark, d: network.eigen_centrality(whole_edges(spark, d)).select("code", r6("score").alias("score")))
query("n06_donor_beta", f"{PAIRS}, p AS (SELECT e.i AS code, s.day, sum(abs(corr) * x) / sum(abs(corr)) AS m FROM edges e JOIN s ON s.code = e.j GROUP BY ALL) SELECT s.code, round(regr_slope(x, m), 5) + 0.0 AS beta FROM s JOIN p ON s.code = p.code AND s.day = p.day GROUP BY s.code")(lambda spark, d: network.donor_beta(small(spark, d), edges_of(spark, d), "x").select("code", F.round("beta", 5).alias("beta")))


# The SQL above compares the codes under 40; these run over the whole panel, for which it would be too slow.


def whole_edges(spark, d):
    return network.nearest(panel(spark, d), "x", 10, 5)


query("n01_pair_correlations_whole")(lambda spark, d: network.pair_correlations(panel(spark, d), "x", 10).select("i", "j", r6("corr").alias("corr"), "n"))
query("n02_neighbours_whole")(lambda spark, d: whole_edges(spark, d).select("i", "j", r6("corr").alias("corr")))
query("n03_peer_stats_whole")(lambda spark, d: network.peer_stats(whole_edges(spark, d), panel(spark, d), "x").select("code", "day", "n_peers", *[r6(c).alias(c) for c in ("peer_mean", "peer_up", "peer_std")]))
query("n04_tightness_whole")(lambda spark, d: network.tightness(whole_edges(spark, d)).select("i", r6("tightness").alias("tightness")))
query("n04_two_hop_whole")(lambda spark, d: network.two_hop(whole_edges(spark, d)))
query("n06_donor_beta_whole")(lambda spark, d: network.donor_beta(panel(spark, d), whole_edges(spark, d), "x").select("code", F.round("beta", 5).alias("beta")))


# --- evaluation and portfolios -----------------------------------------------------------------

EVAL = f"""{GRID}, ev AS (SELECT code, day, x AS score, lead(x) OVER {ORDER} - x AS ret, CAST(vol AS DOUBLE) * 1000 AS liq, n % 3 > 0 AS entry FROM grid), e AS (SELECT * FROM ev WHERE score IS NOT NULL AND ret IS NOT NULL)"""


def scored(spark, d):
    p = panel(spark, d).withColumn("n", S.row())
    return p.select("code", "day", F.col("x").alias("score"), (S.shift(F.col("x"), -1) - F.col("x")).alias("ret"), (F.col("vol").cast("double") * 1000).alias("liq"), (F.col("n") % 3 > 0).alias("entry"))


query("b11_daily_ic", f"{EVAL} SELECT day, count(*) AS n, round(corr(score, ret), 6) + 0.0 AS ic FROM e GROUP BY day")(lambda spark, d: evaluation.daily_ic(scored(spark, d), "score", "ret").select("day", "n", r6("ic").alias("ic")))
query("b11_rank_ic", f"{EVAL}, r AS (SELECT day, rank() OVER (PARTITION BY day ORDER BY score) + (count(*) OVER (PARTITION BY day, score) - 1) / 2.0 AS a, rank() OVER (PARTITION BY day ORDER BY ret) + (count(*) OVER (PARTITION BY day, ret) - 1) / 2.0 AS b FROM e) SELECT day, round(corr(a, b), 6) + 0.0 AS rank_ic FROM r GROUP BY day")(lambda spark, d: evaluation.daily_ic(scored(spark, d), "score", "ret").select("day", r6("rank_ic").alias("rank_ic")))
query("b11_ic_table", f"{EVAL}, c AS (SELECT day, corr(score, ret) AS ic FROM e GROUP BY day) SELECT CAST(date_trunc('week', day) AS DATE) AS period, count(ic) AS n_days, round(avg(ic), 6) + 0.0 AS ic, round(CASE WHEN stddev_samp(ic) > 1e-12 THEN avg(ic) / stddev_samp(ic) END, 5) + 0.0 AS icir FROM c GROUP BY ROLLUP (1)")(lambda spark, d: evaluation.ic_table(evaluation.daily_ic(scored(spark, d), "score", "ret"), F.date_trunc("week", "day").cast("date")).select("period", "n_days", r6("ic").alias("ic"), F.round("icir", 5).alias("icir")))
query("t02_rank_order", f"{EVAL} SELECT day, code, CASE WHEN score IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY day ORDER BY score DESC NULLS LAST, code) AS INTEGER) END AS place FROM ev")(lambda spark, d: evaluation.rank_order(scored(spark, d), "score").select("day", "code", "place"))
query("t05_capacity_portfolio", f"{EVAL}, r AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY score DESC, code) AS k FROM ev WHERE score IS NOT NULL AND liq > 0), h AS (SELECT *, greatest(0, least(liq, 20000 - coalesce(sum(liq) OVER (PARTITION BY day ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS hold FROM r WHERE k <= 50) SELECT day, round(sum(hold * coalesce(ret, 0)) / 20000, 6) + 0.0 AS portfolio_ret, count(*) FILTER (WHERE hold > 0) AS n_held, round(sum(hold) / 20000, 6) + 0.0 AS filled FROM h GROUP BY day")(lambda spark, d: evaluation.capacity_portfolio(scored(spark, d), "score", "liq", "ret", 20000.0, 50).select("day", r6("portfolio_ret").alias("portfolio_ret"), "n_held", r6("filled").alias("filled")))
query("t06_head_tail", f"{EVAL}, r AS (SELECT *, (rank() OVER (PARTITION BY day ORDER BY score) + (count(*) OVER (PARTITION BY day, score) - 1) / 2.0) / count(*) OVER (PARTITION BY day) AS p FROM e) SELECT day, round(avg(ret) FILTER (WHERE p > 0.9), 6) + 0.0 AS head_ret, round(avg(ret) FILTER (WHERE p <= 0.1), 6) + 0.0 AS tail_ret FROM r GROUP BY day")(lambda spark, d: evaluation.head_tail(scored(spark, d), "score", "ret").select("day", r6("head_ret").alias("head_ret"), r6("tail_ret").alias("tail_ret")))
query("t06_capped_by_amount", f"{EVAL}, r AS (SELECT *, sum(liq) OVER (PARTITION BY day ORDER BY score DESC, code ROWS UNBOUNDED PRECEDING) AS c FROM ev WHERE score IS NOT NULL) SELECT day, round(avg(ret), 6) + 0.0 AS capped_ret, count(*) AS n_names FROM r WHERE c <= 15000 GROUP BY day")(lambda spark, d: evaluation.capped_by_amount(scored(spark, d), "score", "liq", "ret", 15000.0).select("day", r6("capped_ret").alias("capped_ret"), "n_names"))
query("t07_realizable_top", f"{EVAL}, r AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY score DESC, code) AS k FROM ev WHERE score IS NOT NULL) SELECT day, round(avg(ret), 6) + 0.0 AS top_ret, round(avg(ret) FILTER (WHERE entry), 6) + 0.0 AS realizable_ret FROM r WHERE k <= 10 GROUP BY day")(lambda spark, d: evaluation.realizable_top(scored(spark, d), "score", "ret", "entry", 10).select("day", r6("top_ret").alias("top_ret"), r6("realizable_ret").alias("realizable_ret")))
query("b10_wpcc", f"{EVAL}, k AS (SELECT *, pow(0.5, (row_number() OVER (PARTITION BY day ORDER BY ret DESC, code) - 1) / (count(*) OVER (PARTITION BY day) - 1)) AS k FROM e), m AS (SELECT day, sum(k * score) / sum(k) AS ma, sum(k * ret) / sum(k) AS mb, sum(k * score * ret) / sum(k) AS ab, sum(k * score * score) / sum(k) AS aa, sum(k * ret * ret) / sum(k) AS bb FROM k GROUP BY day) SELECT day, round((ab - ma * mb) / sqrt((aa - ma * ma) * (bb - mb * mb)), 5) + 0.0 AS wpcc FROM m")(lambda spark, d: evaluation.wpcc(scored(spark, d), "score", "ret").select("day", F.round("wpcc", 5).alias("wpcc")))
query("b15_drawdown", f"{GRID}, v AS (SELECT code, day, exp(sum(ln(1 + coalesce(x / 1000, 0) - 0.008)) OVER (PARTITION BY code ORDER BY day ROWS UNBOUNDED PRECEDING)) AS v FROM grid) SELECT code, day, round(v, 6) + 0.0 AS value, round(v / greatest(1, max(v) OVER (PARTITION BY code ORDER BY day ROWS UNBOUNDED PRECEDING)) - 1, 6) + 0.0 AS drawdown FROM v")(lambda spark, d: evaluation.drawdown(panel(spark, d).select("code", "day", (F.coalesce(F.col("x") / 1000, F.lit(0.0)) - 0.008).alias("r")), "r", ["code"]).select("code", "day", r6("value").alias("value"), r6("drawdown").alias("drawdown")))
query("b06_walk_forward", "WITH s AS (SELECT day, row_number() OVER (ORDER BY day) AS n, count(*) OVER () AS t FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem)), f AS (SELECT *, UNNEST([1, 2, 3, 4]) AS fold FROM s), p AS (SELECT *, t - (4 - fold + 1) * 100 + 1 AS b FROM f) SELECT CAST(fold AS INTEGER) AS fold, CASE WHEN n BETWEEN b AND b + 99 THEN 'test' ELSE 'train' END AS part, day FROM p WHERE n BETWEEN b AND b + 99 OR n BETWEEN b - 10 - 500 AND b - 11")(lambda spark, d: evaluation.walk_forward(table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("day")), 4, 500, 10, 100))
query("b14_fees", "SELECT o_orderkey, round(greatest(o_totalprice * 0.00025, 5) + o_totalprice * 1e-5 + CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 5e-4 ELSE 0 END, 9) + 0.0 AS fee FROM orders")(lambda spark, d: table(spark, d, "orders").select("o_orderkey", F.round(scalar.trade_fee("o_totalprice", F.col("o_orderstatus") == "F"), 9).alias("fee")))
query("b20_extreme_strength", f"{GRID} SELECT code, day, round(greatest(coalesce(x, 0) - 8, 0) + greatest(coalesce(y, 0) - 8, 0), 6) + 0.0 AS value FROM grid")(lambda spark, d: panel(spark, d).select("code", "day", r6(evaluation.extreme_strength(["x", "y"], 8.0)).alias("value")))
query("b03_coverage", f"{GRID} SELECT code, 'x' AS name, round(avg(CASE WHEN x IS NULL THEN 0.0 ELSE 1.0 END), 6) + 0.0 AS coverage FROM grid GROUP BY code")(lambda spark, d: evaluation.covered(panel(spark, d), ["x"], ["code"]).select("code", "name", r6("coverage").alias("coverage")))
query("a25_correlation_matrix", f"{GRID}, c AS (SELECT day, corr(x, y) AS c FROM grid GROUP BY day) SELECT 'x' AS a, 'y' AS b, round(avg(c), 6) + 0.0 AS corr FROM c")(lambda spark, d: evaluation.correlation_matrix(panel(spark, d), ["x", "y"]).select("a", "b", r6("corr").alias("corr")))
query("b13_cash_ledger")(
    lambda spark, d: evaluation.cash_ledger(evaluation.top_rows(panel(spark, d).where("x is not null").withColumn("score", F.sin(F.col("x") * 10)), "score", 30).select(F.lit("base").alias("strategy"), "day", "code", "place", (F.exp(F.col("x")) / 100).alias("price"), F.lit(True).alias("can_buy"), F.lit(True).alias("can_sell"))).select("strategy", "day", F.round("value", 4).alias("value"), "n_held")
)


# --- recursive operators without SQL -----------------------------------------------------------

query("w24_rolling_ols")(lambda spark, d: recursive.rolling_ols(panel(spark, d).withColumn("t", F.sin(F.dayofyear("day"))).select("code", "day", "x", "y", "t"), "x", ["y", "t"], 10).select("code", "day", r6("residual").alias("residual")))
query("w28_first_passage")(lambda spark, d: recursive.first_passage(panel(spark, d).select("code", "day", "x"), "x", "passage", 0.5, 5, 8).select("code", "day", r6("passage").alias("passage")))
query("w29_prospect_value")(lambda spark, d: recursive.prospect_value(panel(spark, d).select("code", F.col("day").alias("month"), (F.col("x") - 8.0).alias("x")), "x", "worth", 12).select("code", "month", r6("worth").alias("worth")))
query("w25_seasonal_innovation")(lambda spark, d: recursive.seasonal_innovation(bitemporal.first_vintage(vintages(spark, d)).select("code", "period", F.log("val").alias("x")), "x", "innovation").select("code", "period", r6("innovation").alias("innovation")))
query("b17_hysteresis")(lambda spark, d: recursive.hysteresis(panel(spark, d).select("code", "day", "x"), "x", "budget", 9.5, 8.5).select("code", "day", "budget"))


# --- increments --------------------------------------------------------------------------------

query("st10_tumbling", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")(lambda spark, d: increments.tumbling(table(spark, d, "events"), "ts", "1 hour", ["event_type"], [F.count(F.lit(1)).alias("n")], "1 day").select(F.col("window.start").alias("start"), "event_type", "n"))
query("st11_sliding", "SELECT CAST(d AS DATE) AS start, count(*) AS n FROM events e JOIN (SELECT UNNEST(generate_series(DATE '2023-12-30', DATE '2024-01-31', INTERVAL 1 DAY)) AS d) ON ts >= d AND ts < d + INTERVAL 3 DAY GROUP BY ALL")(lambda spark, d: increments.sliding(table(spark, d, "events"), "ts", "3 days", "1 day", [], [F.count(F.lit(1)).alias("n")], "1 day").select(F.to_date("window.start").alias("start"), "n"))
query("st12_sessions", "WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k")(lambda spark, d: increments.in_sessions(table(spark, d, "events"), "ts", "6 hours", ["user_id"], [F.count(F.lit(1)).alias("n")], "1 day").select("user_id", F.col("session_window.start").alias("start"), "n"))
query("st09_calendar_gaps", f"{GRID} SELECT g.code, g.day FROM grid g JOIN (SELECT code, min(day) AS a, max(day) AS b FROM facts GROUP BY code) s ON s.code = g.code AND g.day BETWEEN s.a AND s.b WHERE g.vol IS NULL")(lambda spark, d: (lambda f: increments.calendar_gaps(f, f.select("day").distinct(), ["code"]))(facts(spark, d)))
query("st08_ledger_changes", "SELECT CAST(ts AS DATE) AS day, 'rewritten' AS change FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-09' GROUP BY 1")(lambda spark, d: (lambda e: sets.compare_fingerprints(sets.fingerprint(e, ["day"]), sets.fingerprint(e.withColumn("v", F.when(F.col("day") == F.lit("2024-01-09").cast("date"), -1).otherwise(F.col("v"))), ["day"]), ["day"]))(table(spark, d, "events").select(F.to_date("ts").alias("day"), "event_id", F.lit(1).alias("v"))))
query("st02_usual_delay", "WITH a AS (SELECT event_type AS t, CAST(ts AS DATE) AS day, CAST(count(*) % 3 AS INTEGER) AS delay FROM events GROUP BY 1, 2), r AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY t ORDER BY day DESC) <= 10), c AS (SELECT t, delay, count(*) AS n FROM r GROUP BY 1, 2) SELECT t AS \"table\", least(delay, 2) AS delay FROM c QUALIFY row_number() OVER (PARTITION BY t ORDER BY n DESC, delay DESC) = 1")(lambda spark, d: increments.usual_delay(table(spark, d, "events").groupBy(F.col("event_type").alias("table"), F.to_date("ts").alias("day")).agg((F.count(F.lit(1)) % 3).cast("int").alias("delay")).withColumn("declared", F.lit(0))))


def _stream_upsert(spark, d):
    """Events as a stream of files, merged by (user, type), the newest event staying."""
    root = scratch(spark, "upsert")
    stream = increments.file_stream(spark, f"{d}/events.parquet", table(spark, d, "events").schema)
    target = increments.UpsertTable(spark, f"{root}/table", ["user_id", "event_type"], ["event_id"], "event_type")
    target.sink(stream, f"{root}/checkpoint").awaitTermination()
    return target.read().select("user_id", "event_type", "event_id", "value")


query("st05_stream_upsert", "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1")(_stream_upsert)


# --- registry ----------------------------------------------------------------------------------


def _registry(spark, d):
    """Two metrics, one built on the other, through the registry: stored form and rank."""
    dense = panel(spark, d)
    reg = registry.Registry(tables.Catalog(spark, d))
    reg.add(registry.Metric("move", lambda ctx: ctx.grid.select("day", "code", S.diff(F.col("x"), 1).alias("value"))))
    reg.add(registry.Metric("calm", lambda ctx: ctx.parent("move").select("day", "code", (-F.abs("value")).alias("value")), parents=("move",), warmup=1))
    done, failed = registry.run(reg, ["calm"], dense, least=20)
    if failed:
        raise RuntimeError(failed)
    return done["calm"].select("day", "code", F.round(F.col("value").cast("double"), 3).alias("value"))


query("u05_registry_metric", f"{GRID} SELECT day, code, round(CAST(CAST(-abs(x - lag(x) OVER {ORDER}) AS FLOAT) AS DOUBLE), 3) + 0.0 AS value FROM grid")(_registry)
query("s13_plan_days", f"WITH {FACTS}, c AS (SELECT day, row_number() OVER (ORDER BY day) AS n, count(*) OVER () AS t FROM (SELECT DISTINCT day FROM facts)) SELECT day FROM c WHERE n > t - 3 OR day NOT IN (SELECT day FROM facts WHERE day NOT IN (DATE '2024-01-04', DATE '2024-01-11'))")(lambda spark, d: (lambda f: registry.plan_days(f.select("day"), f.where("day not in ('2024-01-04', '2024-01-11')"), tail=3))(facts(spark, d)))
query("b02_wide_snapshot", f"""{GRID}, c AS (SELECT code, day, x, y, CASE WHEN quantile_cont(x, 0.01) OVER (PARTITION BY day) < quantile_cont(x, 0.99) OVER (PARTITION BY day) AND x IS NOT NULL THEN least(greatest(x, quantile_cont(x, 0.01) OVER (PARTITION BY day)), quantile_cont(x, 0.99) OVER (PARTITION BY day)) ELSE x END AS v FROM grid)
SELECT code, day, round(CASE WHEN v IS NOT NULL AND stddev_pop(v) OVER (PARTITION BY day) > 1e-12 THEN least(greatest((v - avg(v) OVER (PARTITION BY day)) / stddev_pop(v) OVER (PARTITION BY day), -10), 10) END, 6) + 0.0 AS fx FROM c""")(lambda spark, d: (lambda p: registry.wide_snapshot({"fx": p.select("day", "code", F.col("x").alias("value")), "fy": p.select("day", "code", F.col("y").alias("value"))}, least=1).select("code", "day", r6("fx").alias("fx")))(panel(spark, d)))


# --- price layer -------------------------------------------------------------------------------

PRICES = f"""{GRID}, ff AS (SELECT *, last_value(x IGNORE NULLS) OVER (PARTITION BY code ORDER BY day ROWS UNBOUNDED PRECEDING) AS fx, last_value(y + 2 IGNORE NULLS) OVER (PARTITION BY code ORDER BY day ROWS UNBOUNDED PRECEDING) AS fy FROM grid),
h AS (SELECT *, fx * fy AS adj FROM ff), d AS (SELECT *, CASE WHEN abs(adj / lag(adj) OVER {ORDER} - 1) <= 0.6 THEN adj / lag(adj) OVER {ORDER} - 1 END AS r, coalesce(vol > 0, FALSE) AS traded FROM h)"""


def priced(spark, d):
    p = panel(spark, d).withColumn("adj", prices.adjusted(F.col("x"), F.col("y") + 2)).withColumn("traded", prices.was_traded(F.col("vol")))
    return p.withColumn("r", prices.daily_return(F.col("adj")))


query("l01_adjusted", f"{PRICES} SELECT code, day, round(adj, 6) + 0.0 AS adj, round(r, 6) + 0.0 AS r FROM d")(lambda spark, d: priced(spark, d).select("code", "day", r6("adj").alias("adj"), r6("r").alias("r")))
query("l03_period_return", f"{PRICES} SELECT code, day, round(CASE WHEN n >= 5 AND count(r) OVER {w(5)} = 5 AND count(*) FILTER (WHERE traded) OVER {w(5)} > 0 THEN exp(sum(ln(1 + r)) OVER {w(5)}) - 1 END, 6) + 0.0 AS value FROM d")(lambda spark, d: priced(spark, d).select("code", "day", r6(prices.period_return(F.col("r"), F.col("traded"), 5)).alias("value")))
query("l04_clean_return", f"{PRICES}, c AS (SELECT *, CASE WHEN traded THEN r END AS q FROM d) SELECT code, day, round(CASE WHEN n >= 3 AND count(q) OVER {w(3)} = 3 THEN exp(sum(ln(1 + q)) OVER {w(3)}) - 1 END, 6) + 0.0 AS value FROM c")(lambda spark, d: priced(spark, d).select("code", "day", r6(prices.clean_return(F.col("r"), F.col("traded"), 3)).alias("value")))
query("l05_turnover", f"{PRICES} SELECT code, day, round(CASE WHEN fx > 1 THEN vol / fx * 100 END, 6) + 0.0 AS value FROM d")(lambda spark, d: panel(spark, d).select("code", "day", r6(prices.turnover(F.col("vol"), F.col("x"))).alias("value")))
query("l07_forward_label", f"{PRICES}, t AS (SELECT *, CAST(traded AS INTEGER) AS k FROM d) SELECT code, day, round(CASE WHEN lead(k, 1) OVER {ORDER} + lead(k, 4) OVER {ORDER} = 2 THEN lead(adj, 4) OVER {ORDER} / lead(adj, 1) OVER {ORDER} - 1 END, 6) + 0.0 AS value FROM t")(lambda spark, d: priced(spark, d).select("code", "day", r6(prices.forward_return(F.col("adj"), F.col("traded"), 3)).alias("value")))
query("b07_covered_window", f"{GRID} SELECT code, day, coalesce(CASE WHEN n >= 4 THEN min(CASE WHEN x IS NULL THEN 0.0 ELSE 1.0 END) OVER {w(4)} >= 0.5 END, FALSE) AS covered FROM grid")(lambda spark, d: panel(spark, d).select("code", "day", prices.covered_window(F.col("x").isNotNull().cast("double"), 4, 0.5).alias("covered")))
query("b08_hot_pool", f"""{GRID}, m AS (SELECT code, day, CASE WHEN n >= 5 AND count(x) OVER {w(5)} >= 1 THEN avg(x) OVER {w(5)} END AS a, CASE WHEN n >= 5 AND count(y) OVER {w(5)} >= 1 THEN avg(y) OVER {w(5)} END AS b FROM grid),
r AS (SELECT code, day, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN ((rank() OVER (PARTITION BY day ORDER BY a) + (count(*) OVER (PARTITION BY day, a) - 1) / 2.0) / count(a) OVER (PARTITION BY day) + (rank() OVER (PARTITION BY day ORDER BY b) + (count(*) OVER (PARTITION BY day, b) - 1) / 2.0) / count(b) OVER (PARTITION BY day)) / 2 END AS s FROM m)
SELECT code, day, coalesce(CASE WHEN s IS NOT NULL THEN (rank() OVER (PARTITION BY day ORDER BY round(s, 9)) + (count(*) OVER (PARTITION BY day, round(s, 9)) - 1) / 2.0) / count(s) OVER (PARTITION BY day) > 0.8 END, FALSE) AS hot FROM r""")(lambda spark, d: prices.hot_pool(panel(spark, d), {"a": F.col("x"), "b": F.col("y")}, 5, 0.2).select("code", "day", "hot"))
query("f09_announced_window", f"{GRID}, c AS (SELECT day, row_number() OVER (ORDER BY day) AS k FROM cal), e AS (SELECT DISTINCT f.code, c.k FROM facts f JOIN c ON c.day = f.day WHERE f.errors > 1) SELECT g.code, g.day, EXISTS (SELECT 1 FROM e WHERE e.code = g.code AND c.k BETWEEN e.k - 3 AND e.k) AS announced FROM grid g JOIN c ON c.day = g.day")(lambda spark, d: (lambda f, p: prices.announced_window(p.select("code", "day"), f.where("errors > 1"), f.select("day"), 3).select("code", "day", "announced"))(facts(spark, d), panel(spark, d)))


# --- flagship ----------------------------------------------------------------------------------

query("q01_momentum_rank", f"""{GRID}, m AS (SELECT code, day, CASE WHEN n >= 6 THEN x - lag(x, 5) OVER {ORDER} END AS v FROM grid),
k AS (SELECT code, day, v, count(v) OVER (PARTITION BY day) AS c, rank() OVER (PARTITION BY day ORDER BY v ASC NULLS LAST) AS lo, rank() OVER (PARTITION BY day ORDER BY v DESC NULLS LAST) AS hi FROM m)
SELECT code, day, round(v, 6) + 0.0 AS value, round(CASE WHEN c >= 5 AND v IS NOT NULL THEN (lo + c - hi + 1) / 2.0 / c END, 6) + 0.0 AS rank FROM k""")(
    lambda spark, d: panel(spark, d).select("code", "day", S.diff(F.col("x"), 5).alias("v")).select("code", "day", r6("v").alias("value"), r6(F.when(F.count("v").over(Window.partitionBy("day")) >= 5, cross.pct_rank(F.col("v")))).alias("rank"))
)


from . import queries_more  # noqa: E402, F401  (further queries join the same dictionaries)
