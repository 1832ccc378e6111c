"""Salary table and group split on orders.

Total price stands for a yearly, monthly, ... salary, order priority for the pay
period and order status for the currency.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright import defaults
from sievewright.operators import split, target
from sievewright.queries.registry import query, rounded, table
from sievewright.specs import SalaryConfig, SplitConfig

CONFIG = SalaryConfig(
    periods_per_year=defaults.SALARY.periods_per_year,
    predictors=("priority", "followers", "absent_predictor"),
    metadata=("o_orderkey", "dataset_version"),
    leakage=defaults.SALARY.leakage,
    group_parts=("title", "company", "absent_part"),
    log_features=("followers", "absent_count"),
)


def postings(spark: SparkSession, folder: str) -> DataFrame:
    """Orders dressed as postings, with gaps and bad values by formula."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    period = F.when(F.col("o_orderpriority") == "1-URGENT", " Yearly ").when(
        F.col("o_orderpriority") == "2-HIGH", "MONTHLY"
    )
    period = period.when(F.col("o_orderpriority") == "3-MEDIUM", "hourly").when(
        F.col("o_orderpriority") == "4-NOT SPECIFIED", "weekly"
    )
    divisor = F.when(F.col("o_orderpriority") == "1-URGENT", 1.0).when(F.col("o_orderpriority") == "2-HIGH", 12.0)
    divisor = divisor.when(F.col("o_orderpriority") == "3-MEDIUM", 2080.0).otherwise(52.0)
    low = price / divisor
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(key % 5 == 0, None).when(key % 11 == 0, -low).otherwise(low).alias("min_salary"),
        F.when(key % 5 == 0, None).when(key % 13 == 0, low / 2).otherwise(low * 1.5).alias("max_salary"),
        F.when(key % 10 == 0, None).when(key % 17 == 0, F.lit(-1.0)).otherwise(low).alias("med_salary"),
        period.otherwise("once").alias("pay_period"),
        F.when(F.col("o_orderstatus") == "P", "EUR").when(key % 19 == 0, None).otherwise(" USD").alias("currency"),
        F.col("o_orderpriority").alias("priority"),
        (F.col("o_custkey") - 50).alias("followers"),
        F.concat(F.lit(" Clerk  "), (F.col("o_custkey") % 40).cast("string")).alias("title"),
        F.when(key % 3 != 0, F.concat(F.lit("Company "), (F.col("o_custkey") % 7).cast("string"))).alias("company"),
        F.when(F.col("o_orderdate") < "1999-01-01", "Version_1").otherwise("Version_2").alias("dataset_version"),
    )


_POSTINGS = """
    base AS (
      SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN ' Yearly ' WHEN '2-HIGH' THEN 'MONTHLY' WHEN '3-MEDIUM' THEN 'hourly'
                WHEN '4-NOT SPECIFIED' THEN 'weekly' ELSE 'once' END AS pay_period,
             o_totalprice / CASE o_orderpriority WHEN '1-URGENT' THEN 1.0::DOUBLE WHEN '2-HIGH' THEN 12.0::DOUBLE
                   WHEN '3-MEDIUM' THEN 2080.0::DOUBLE ELSE 52.0::DOUBLE END AS low FROM orders),
    postings AS (
      SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN -low ELSE low END AS min_salary,
             CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN low / 2 ELSE low * 1.5::DOUBLE END AS max_salary,
             CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN -1 ELSE low END AS med_salary, pay_period,
             CASE WHEN o_orderstatus = 'P' THEN 'EUR' WHEN o_orderkey % 19 = 0 THEN NULL ELSE ' USD' END AS currency,
             o_orderpriority AS priority, o_custkey - 50 AS followers, ' Clerk  ' || (o_custkey % 40) AS title,
             CASE WHEN o_orderkey % 3 <> 0 THEN 'Company ' || (o_custkey % 7) END AS company,
             CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'Version_1' ELSE 'Version_2' END AS dataset_version FROM base),
    raw AS (
      SELECT *, CASE WHEN min_salary > 0 AND min_salary <= max_salary THEN (min_salary + max_salary) / 2
                     WHEN med_salary > 0 THEN med_salary END AS raw_salary,
             CASE WHEN min_salary > 0 AND min_salary <= max_salary THEN 'RANGE_MIDPOINT'
                  WHEN med_salary > 0 THEN 'MEDIAN_SALARY' END AS source,
             CASE lower(trim(pay_period)) WHEN 'yearly' THEN 1.0::DOUBLE WHEN 'monthly' THEN 12.0::DOUBLE
                  WHEN 'biweekly' THEN 26.0::DOUBLE WHEN 'weekly' THEN 52.0::DOUBLE WHEN 'hourly' THEN 2080.0::DOUBLE END AS per_year
      FROM postings),
    staged AS (
      SELECT *, raw_salary * per_year AS annual,
             CASE WHEN coalesce(min_salary, med_salary, max_salary) IS NULL THEN 'missing' WHEN raw_salary IS NULL THEN 'invalid'
                  WHEN coalesce(lower(trim(currency)), '') <> 'usd' THEN 'currency' WHEN per_year IS NULL THEN 'pay_period'
                  WHEN raw_salary * per_year NOT BETWEEN 10000 AND 1000000 THEN 'bounds' ELSE 'kept' END AS status FROM raw),
    salary AS (
      SELECT *, ln(1 + annual) AS log_annual,
             sha256(lower(trim(regexp_replace(title, '\\s+', ' ', 'g'))) || '||' ||
                    lower(coalesce(company, 'unknown')) || '||unknown') AS group_id
      FROM staged WHERE status = 'kept')
"""


def _salary(spark: SparkSession, folder: str) -> target.SalaryTable:
    return target.build_salary_table(postings(spark, folder), CONFIG)


@query(
    "salary_table",
    f"""
    WITH {_POSTINGS}
    SELECT o_orderkey, round(annual, 4) AS target_annual_salary, round(log_annual, 6) AS target_log_salary,
           source AS salary_target_source, priority, followers,
           round(coalesce(CASE WHEN followers >= 0 THEN ln(1 + followers) END, -1), 6) AS log_followers,
           -1.0::DOUBLE AS log_absent_count, group_id AS posting_group_id, dataset_version FROM salary
    """,
)
def salary_table(spark: SparkSession, folder: str) -> DataFrame:
    result = rounded(_salary(spark, folder).result.fillna(-1.0, subset=["log_followers", "log_absent_count"]))
    return result.withColumn("target_annual_salary", F.round("target_annual_salary", 4))


@query(
    "salary_funnel",
    f"""
    WITH {_POSTINGS}
    SELECT count(*) AS rows_in, count(*) FILTER (WHERE status = 'missing') AS missing_salary,
           count(*) FILTER (WHERE status = 'invalid') AS invalid_salary,
           count(*) FILTER (WHERE status NOT IN ('missing', 'invalid')) AS candidates,
           count(*) FILTER (WHERE status = 'currency') AS removed_currency,
           count(*) FILTER (WHERE status IN ('pay_period', 'bounds', 'kept')) AS allowed_currency,
           count(*) FILTER (WHERE status = 'pay_period') AS removed_pay_period,
           count(*) FILTER (WHERE status = 'bounds') AS removed_bounds, count(*) FILTER (WHERE status = 'kept') AS kept
    FROM staged
    """,
)
def salary_funnel(spark: SparkSession, folder: str) -> DataFrame:
    return target.funnel(_salary(spark, folder).staged)


@query(
    "salary_integrity",
    f"""
    WITH {_POSTINGS}
    SELECT "check", violations FROM (VALUES
      ('no_rows', (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM salary)),
      ('null_target', (SELECT count(*) FROM salary WHERE annual IS NULL OR source IS NULL)),
      ('target_out_of_bounds', (SELECT count(*) FROM salary WHERE annual NOT BETWEEN 10000 AND 1000000)),
      ('infinite_value', (SELECT count(*) FROM salary WHERE isinf(annual))),
      ('null_group', (SELECT count(*) FROM salary WHERE group_id IS NULL)),
      ('log_mismatch', (SELECT count(*) FROM salary WHERE abs(log_annual - ln(1 + annual)) > 1e-9)),
      ('repeated_or_index_column', 0)) AS t("check", violations)
    """,
)
def salary_integrity(spark: SparkSession, folder: str) -> DataFrame:
    return target.integrity(_salary(spark, folder).result, CONFIG)


@query(
    "salary_description",
    f"""
    WITH {_POSTINGS}
    SELECT count(*) AS count, min(annual) AS min, max(annual) AS max, round(avg(annual), 4) AS mean,
           round(stddev_samp(annual), 4) AS std, round(quantile_cont(annual, 0.5), 4) AS median
    FROM (SELECT round(annual, 4) AS annual FROM salary)
    """,
)
def salary_description(spark: SparkSession, folder: str) -> DataFrame:
    annual = _salary(spark, folder).result.select(F.round(target.ANNUAL, 4).alias("annual"))
    return rounded(target.describe(annual, "annual"), 4)


@query(
    "salary_sources",
    f"WITH {_POSTINGS} SELECT source AS salary_target_source, count(*) AS rows FROM salary GROUP BY source",
)
def salary_sources(spark: SparkSession, folder: str) -> DataFrame:
    return target.label_counts(_salary(spark, folder).result)


@query(
    "salary_coverage",
    f"WITH {_POSTINGS} SELECT round(100.0 * count(*) FILTER (WHERE status = 'kept') / count(*), 6) AS coverage FROM staged",
)
def salary_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(target.coverage(_salary(spark, folder).staged))


# ----------------------------------------------------------------------- split

BY_CUSTOMER = SplitConfig(group="o_custkey", targets=("o_totalprice", "log_price"))

_SPLIT_SQL = """
    ranked AS (
      SELECT o_custkey, row_number() OVER (ORDER BY sha256('42|' || o_custkey)) AS r, count(*) OVER () AS n
      FROM (SELECT DISTINCT o_custkey FROM orders)),
    sized AS (SELECT *, ceil(round(0.2::DOUBLE * n, 9)) AS test_n FROM ranked),
    labelled AS (
      SELECT o_custkey, CASE WHEN r <= test_n THEN 'test'
             WHEN r <= test_n + ceil(round((n - test_n) * (0.1::DOUBLE / 0.8::DOUBLE), 9)) THEN 'validation' ELSE 'train' END AS split
      FROM sized),
    parts AS (SELECT o_orderkey, o_custkey, o_totalprice, split FROM orders JOIN labelled USING (o_custkey))
"""


def _split(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return split.group_split(orders, BY_CUSTOMER)


@query("split_labels", f"WITH {_SPLIT_SQL} SELECT o_orderkey, o_custkey, split FROM parts")
def split_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder).select("o_orderkey", "o_custkey", "split")


@query(
    "split_sizes",
    f"""
    WITH {_SPLIT_SQL}
    SELECT split, rows, groups, round(rows / total, 6) AS actual, requested, round(abs(rows / total - requested), 6) AS deviation
    FROM (SELECT split, count(*) AS rows, count(DISTINCT o_custkey) AS groups,
                 CASE split WHEN 'train' THEN 0.7::DOUBLE WHEN 'test' THEN 0.2::DOUBLE ELSE 0.1::DOUBLE END AS requested
          FROM parts GROUP BY split), (SELECT count(*) AS total FROM orders)
    """,
)
def split_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(split.part_sizes(_split(spark, folder), BY_CUSTOMER))


@query(
    "split_group_overlap",
    f"""
    WITH {_SPLIT_SQL}
    SELECT count(*) FILTER (WHERE a AND b) AS train_validation, count(*) FILTER (WHERE a AND c) AS train_test,
           count(*) FILTER (WHERE b AND c) AS validation_test
    FROM (SELECT bool_or(split = 'train') AS a, bool_or(split = 'validation') AS b, bool_or(split = 'test') AS c
          FROM parts GROUP BY o_custkey)
    """,
)
def split_group_overlap(spark: SparkSession, folder: str) -> DataFrame:
    return split.group_overlap(_split(spark, folder), BY_CUSTOMER)


@query(
    "split_by_other_key_overlap",
    f"""
    WITH {_SPLIT_SQL},
    other AS (SELECT o_orderkey % 1000 AS k, split FROM parts)
    SELECT count(*) FILTER (WHERE a AND b) AS train_validation, count(*) FILTER (WHERE a AND c) AS train_test,
           count(*) FILTER (WHERE b AND c) AS validation_test
    FROM (SELECT bool_or(split = 'train') AS a, bool_or(split = 'validation') AS b, bool_or(split = 'test') AS c
          FROM other GROUP BY k)
    """,
)
def split_by_other_key_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """The overlap check on a key the split does not respect finds the overlaps."""
    other = _split(spark, folder).select((F.col("o_orderkey") % 1000).alias("k"), "split")
    return split.group_overlap(other, SplitConfig(group="k"))


@query(
    "split_row_overlap",
    f"""
    WITH {_SPLIT_SQL}
    SELECT count(*) AS shared_rows FROM (SELECT o_orderkey FROM parts GROUP BY o_orderkey HAVING count(DISTINCT split) > 1)
    """,
)
def split_row_overlap(spark: SparkSession, folder: str) -> DataFrame:
    return split.row_overlap(_split(spark, folder), "o_orderkey")


@query(
    "split_statistics",
    f"""
    WITH {_SPLIT_SQL}
    SELECT split, count(o_totalprice) AS count, count(*) - count(o_totalprice) AS null_targets, min(o_totalprice) AS min,
           max(o_totalprice) AS max, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std,
           round(quantile_cont(o_totalprice, 0.5), 4) AS median
    FROM parts GROUP BY split
    """,
)
def split_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(split.part_statistics(_split(spark, folder), "o_totalprice"), 4)


@query(
    "split_input_report",
    """
    WITH input AS (
      SELECT CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END AS g,
             CASE WHEN o_orderkey % 20 = 0 THEN NULL WHEN o_orderkey % 30 = 1 THEN -1 ELSE o_totalprice END AS p,
             CASE WHEN o_orderkey % 40 = 3 THEN 'Infinity'::DOUBLE ELSE o_totalprice END AS q FROM orders)
    SELECT 'null_group' AS "check", count(*) FILTER (WHERE g IS NULL) AS violations FROM input
    UNION ALL SELECT 'null_target', count(*) FILTER (WHERE p IS NULL OR q IS NULL) FROM input
    UNION ALL SELECT 'not_finite', count(*) FILTER (WHERE isinf(q)) FROM input
    UNION ALL SELECT 'not_positive', count(*) FILTER (WHERE p <= 0) FROM input
    UNION ALL SELECT 'too_few_groups', CASE WHEN count(DISTINCT g) < 10 THEN 1 ELSE 0 END FROM input
    """,
)
def split_input_report(spark: SparkSession, folder: str) -> DataFrame:
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    orders = table(spark, folder, "orders").select(
        F.when(key % 50 != 0, F.col("o_custkey")).alias("g"),
        F.when(key % 20 == 0, None).when(key % 30 == 1, -1.0).otherwise(price).alias("p"),
        F.when(key % 40 == 3, float("inf")).otherwise(price).alias("q"),
    )
    return split.input_report(orders, SplitConfig(group="g", targets=("p", "q")))
