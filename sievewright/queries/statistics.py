"""Group statistics, correlations, outliers and distributions."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.operators import quantiles, stats
from sievewright.queries.registry import query, rounded, table

_QUARTILES = """round(quantile_cont({x}, 0.25), {d}) AS p25, round(quantile_cont({x}, 0.5), {d}) AS median,
           round(quantile_cont({x}, 0.75), {d}) AS p75"""


def _moments(x: str, d: int = 4) -> str:
    return f"count({x}) AS count, round(avg({x}), {d}) AS mean, round(stddev_samp({x}), {d}) AS std, " + _QUARTILES.format(x=x, d=d)


@query(
    "group_statistics",
    f"SELECT o_orderpriority, {_moments('o_totalprice')} FROM orders GROUP BY o_orderpriority",
)
def group_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stats.group_stats(table(spark, folder, "orders"), ["o_orderpriority"], "o_totalprice"), 4)


@query(
    "group_statistics_of_few_groups",
    f"SELECT l_returnflag, {_moments('l_extendedprice')} FROM lineitem GROUP BY l_returnflag",
)
def group_statistics_of_few_groups(spark: SparkSession, folder: str) -> DataFrame:
    """A quarter of all lines in a group."""
    aggregates = [
        F.count("l_extendedprice").alias("count"),
        F.avg("l_extendedprice").alias("mean"),
        F.stddev_samp("l_extendedprice").alias("std"),
    ]
    lines = table(spark, folder, "lineitem")
    result = quantiles.group_statistics(lines, ["l_returnflag"], "l_extendedprice", stats.QUARTILES, aggregates)
    return rounded(result, 4)


@query(
    "overall_quantiles",
    f"SELECT count(*) AS rows, {_QUARTILES.format(x='l_quantity', d=4)} FROM lineitem",
)
def overall_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    result = quantiles.group_statistics(lines, [], "l_quantity", stats.QUARTILES, [F.count("*").alias("rows")])
    return rounded(result, 4)


# whole numbers, so that the sums are exact and rounding agrees at any scale
@query(
    "group_statistics_supported",
    f"""
    SELECT l_partkey, {_moments('l_quantity', 6)},
           round(quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25), 6) AS iqr
    FROM lineitem GROUP BY l_partkey HAVING count(*) >= 30
    """,
)
def group_statistics_supported(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stats.supported_group_stats(table(spark, folder, "lineitem"), ["l_partkey"], "l_quantity", 30), 6)


@query(
    "rate_by_group",
    """
    SELECT l_suppkey, count(*) AS rows, count(*) FILTER (WHERE l_returnflag = 'R') AS hits,
           count(*) FILTER (WHERE l_returnflag <> 'R') AS misses,
           round(100.0 * count(*) FILTER (WHERE l_returnflag = 'R') / count(*), 6) AS rate_percent
    FROM lineitem GROUP BY l_suppkey ORDER BY rows DESC, l_suppkey LIMIT 15
    """,
)
def rate_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stats.rate_by_group(table(spark, folder, "lineitem"), "l_suppkey", F.col("l_returnflag") == "R", 15))


@query(
    "conditional_counts",
    """
    SELECT l_linestatus, count(*) FILTER (WHERE l_discount > 0.05) AS discounted,
           count(*) FILTER (WHERE l_quantity >= 40) AS bulky, count(*) FILTER (WHERE l_tax = 0) AS untaxed
    FROM lineitem GROUP BY l_linestatus
    """,
)
def conditional_counts(spark: SparkSession, folder: str) -> DataFrame:
    conditions = {
        "discounted": F.col("l_discount") > 0.05,
        "bulky": F.col("l_quantity") >= 40,
        "untaxed": F.col("l_tax") == 0,
    }
    return stats.conditional_counts(table(spark, folder, "lineitem"), "l_linestatus", conditions)


@query(
    "pivoted_medians",
    """
    SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.5) FILTER (WHERE o_orderstatus = 'O'), 4) AS "O",
           round(quantile_cont(o_totalprice, 0.5) FILTER (WHERE o_orderstatus = 'F'), 4) AS "F",
           round(quantile_cont(o_totalprice, 0.5) FILTER (WHERE o_orderstatus = 'P'), 4) AS "P"
    FROM orders GROUP BY o_orderpriority
    """,
)
def pivoted_medians(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return rounded(
        stats.pivoted_medians(orders, "o_orderpriority", "o_orderstatus", ["O", "F", "P"], "o_totalprice"), 4
    )


@query(
    "ranked_medians",
    """
    WITH m AS (SELECT l_suppkey, quantile_cont(l_quantity, 0.5) AS median FROM lineitem GROUP BY l_suppkey)
    SELECT l_suppkey, round(median, 4) AS median,
           rank() OVER (ORDER BY median) + (count(*) OVER (PARTITION BY median) - 1) / 2 AS rank FROM m
    """,
)
def ranked_medians(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stats.ranked_medians(table(spark, folder, "lineitem"), "l_suppkey", "l_quantity"), 4)


@query(
    "group_first_values",
    """
    SELECT user_id, count(*) AS rows, arg_min(event_type, event_id) AS event_type,
           arg_min(v, event_id) FILTER (WHERE v IS NOT NULL) AS v
    FROM (SELECT user_id, event_id, event_type, CASE WHEN event_id % 3 <> 0 THEN value END AS v FROM events) GROUP BY user_id
    """,
)
def group_first_values(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("v", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    return stats.group_first(events, "user_id", ["event_type", "v"], "event_id")


# ----------------------------------------------------------------- correlation

_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
    for i, a in enumerate(_NUMBERS)
    for b in _NUMBERS[i + 1 :]
)


@query("correlation_matrix", _PAIRS)
def correlation_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stats.correlation_matrix(table(spark, folder, "lineitem"), _NUMBERS))


_MANY = {f"m{i}": (a, k) for i, (a, k) in enumerate((a, k) for a in ("l_quantity", "l_extendedprice", "l_discount", "l_tax") for k in range(2, 7))}


def _many_sql() -> str:
    """Powers of four columns, each with gaps of its own."""
    made = ", ".join(f"CASE WHEN (l_partkey + {i}) % {k + 1} <> 0 THEN pow({a}, 1.0 / {k}) END AS {m}" for i, (m, (a, k)) in enumerate(_MANY.items()))
    pairs = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM many" for a, b in combinations(_MANY, 2))
    return f"WITH many AS MATERIALIZED (SELECT {made} FROM lineitem) {pairs}"


@query("correlation_of_many_columns", _many_sql())
def correlation_of_many_columns(spark: SparkSession, folder: str) -> DataFrame:
    made = [
        F.when((F.col("l_partkey") + i) % (k + 1) != 0, F.pow(a, F.lit(1.0 / k))).alias(m) for i, (m, (a, k)) in enumerate(_MANY.items())
    ]
    return rounded(stats.gram_correlations(table(spark, folder, "lineitem").select(*made), list(_MANY)))


@query("correlation_strong_pairs", f"SELECT * FROM ({_PAIRS}) WHERE abs(r) > 0.001")
def correlation_strong_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stats.strong_pairs(table(spark, folder, "lineitem"), _NUMBERS, 0.001))


@query(
    "correlation_with_gaps",
    """
    SELECT 'x' AS a, 'y' AS b, round(corr(x, y), 6) AS r FROM (
      SELECT CASE WHEN l_partkey % 5 <> 0 THEN l_quantity END AS x, CASE WHEN l_suppkey % 4 <> 0 THEN l_extendedprice END AS y
      FROM lineitem)
    """,
)
def correlation_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_quantity")).alias("x"),
        F.when(F.col("l_suppkey") % 4 != 0, F.col("l_extendedprice")).alias("y"),
    )
    return rounded(stats.correlation_matrix(lines, ["x", "y"]))


@query(
    "correlation_spearman",
    """
    WITH r AS (
      SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2 AS rx,
             rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2 AS ry FROM lineitem)
    SELECT round(corr(rx, ry), 6) AS r FROM r
    """,
)
def correlation_spearman(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stats.spearman(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice"))


@query(
    "correlation_log_log",
    """
    SELECT round(corr(ln(1 + greatest(c_acctbal, 0)), ln(1 + greatest(n, 0))), 6) AS r
    FROM (SELECT c_acctbal, (c_nationkey - 5)::DOUBLE AS n FROM customer)
    """,
)
def correlation_log_log(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_acctbal", (F.col("c_nationkey") - 5).alias("n"))
    return rounded(stats.log_log_correlation(customer, "c_acctbal", "n"))


@query(
    "anova_by_group",
    """
    WITH g AS (SELECT l_suppkey, count(*) AS n, avg(l_extendedprice) AS m, var_samp(l_extendedprice) AS v,
                      quantile_cont(l_extendedprice, 0.5) AS med FROM lineitem GROUP BY l_suppkey HAVING count(*) > 1),
    t AS (SELECT sum(n * m) / sum(n) AS grand FROM g)
    SELECT count(*) AS groups, sum(n)::BIGINT AS rows,
           round((sum(n * (m - grand) ** 2) / (count(*) - 1)) / (sum((n - 1) * v) / (sum(n) - count(*))), 6) AS f_statistic,
           round(max(med) - min(med), 4) AS median_spread FROM g, t
    """,
)
def anova_by_group(spark: SparkSession, folder: str) -> DataFrame:
    result = rounded(stats.anova(table(spark, folder, "lineitem"), "l_suppkey", "l_extendedprice"))
    return result.withColumn("median_spread", F.round("median_spread", 4))


# ------------------------------------------------------- outliers, distribution


@query(
    "outliers_iqr",
    """
    WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
    f AS (SELECT q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM q)
    SELECT round(lo, 4) AS lower_fence, round(hi, 4) AS upper_fence, count(*) AS rows,
           count(*) FILTER (WHERE value < lo OR value > hi) AS outliers,
           round(100.0 * count(*) FILTER (WHERE value < lo OR value > hi) / count(*), 4) AS outlier_percent
    FROM events, f GROUP BY lo, hi
    """,
)
def outliers_iqr(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stats.iqr_outliers(table(spark, folder, "events"), "value"), 4)


@query(
    "percentile_clip",
    """
    WITH q AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM events)
    SELECT event_id, value FROM events, q WHERE value BETWEEN lo AND hi
    """,
)
def percentile_clip(spark: SparkSession, folder: str) -> DataFrame:
    return stats.between_percentiles(table(spark, folder, "events").select("event_id", "value"), "value", 0.01, 0.99)


@query(
    "histogram_equal_width",
    """
    WITH l AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
    c AS (SELECT least(floor((value - lo) / (hi - lo) * 20), 19)::INT AS bin, count(*) AS n FROM events, l GROUP BY 1)
    SELECT b::INT AS bin, round(lo + b * (hi - lo) / 20, 4) AS from_value, round(lo + (b + 1) * (hi - lo) / 20, 4) AS to_value,
           coalesce(n, 0) AS rows
    FROM l, range(20) AS s(b) LEFT JOIN c ON c.bin = b
    """,
)
def histogram_equal_width(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stats.histogram(table(spark, folder, "events"), "value", 20), 4)


@query(
    "five_number_summary",
    """
    SELECT event_type, min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.25), 4) AS p25,
           round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.75), 4) AS p75
    FROM events GROUP BY event_type
    """,
)
def five_number_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stats.five_numbers(table(spark, folder, "events"), ["event_type"], "value"), 4)


_ECDF_SQL = "SELECT DISTINCT l_extendedprice, round(cume_dist() OVER (ORDER BY l_extendedprice), 6) AS share FROM lineitem"


@query("empirical_distribution", _ECDF_SQL)
def empirical_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stats.ecdf(table(spark, folder, "lineitem"), "l_extendedprice"))


@query(
    "median_ratio",
    """
    SELECT p_brand, count(*) AS rows, round(quantile_cont(l_extendedprice / p_retailprice, 0.5), 6) AS median_ratio
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
    """,
)
def median_ratio(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").withColumnRenamed("p_partkey", "l_partkey")
    joined = table(spark, folder, "lineitem").join(part, "l_partkey")
    return rounded(stats.median_ratio(joined, "p_brand", F.col("l_extendedprice"), F.col("p_retailprice")))


@query(
    "share_within_tolerance",
    """
    SELECT count(*) AS rows, round(100.0 * count(*) FILTER (WHERE abs(l_quantity - p_size) < 5) / count(*), 6) AS close_percent
    FROM lineitem JOIN part ON l_partkey = p_partkey
    """,
)
def share_within_tolerance(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").withColumnRenamed("p_partkey", "l_partkey")
    joined = table(spark, folder, "lineitem").join(part, "l_partkey")
    return rounded(stats.share_within(joined, F.col("l_quantity"), F.col("p_size"), 5))


@query(
    "waterfall_of_exclusions",
    """
    SELECT count(*) AS rows_in, count(*) FILTER (WHERE a) AS no_discount, count(*) FILTER (WHERE NOT a AND b) AS returned,
           count(*) FILTER (WHERE NOT a AND NOT b AND c) AS small_quantity,
           count(*) FILTER (WHERE NOT a AND NOT b AND NOT c) AS kept,
           round(100.0 * count(*) FILTER (WHERE NOT a AND NOT b AND NOT c) / count(*), 6) AS kept_percent
    FROM (SELECT l_discount = 0 AS a, l_returnflag = 'R' AS b, l_quantity < 5 AS c FROM lineitem)
    """,
)
def waterfall_of_exclusions(spark: SparkSession, folder: str) -> DataFrame:
    stages = {
        "no_discount": F.col("l_discount") == 0,
        "returned": F.col("l_returnflag") == "R",
        "small_quantity": F.col("l_quantity") < 5,
    }
    return rounded(stats.waterfall(table(spark, folder, "lineitem"), stages))
