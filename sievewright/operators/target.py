"""Salary modelling table: regression target, features, group id.

Everything up to the projection is row-local, so the table is one narrow pass
over the feature store.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions import columns as X
from sievewright.operators import quantiles
from sievewright.specs import SalaryConfig

ANNUAL = "target_annual_salary"
LOG = "target_log_salary"
SOURCE = "salary_target_source"
GROUP = "posting_group_id"

# Labels of the two ways to get a raw salary.
RANGE_MIDPOINT = "RANGE_MIDPOINT"
MEDIAN_SALARY = "MEDIAN_SALARY"

_STATUS = "_sw_status"


class SalaryTableInvalid(ValueError):
    pass


def check_columns(df: DataFrame, config: SalaryConfig) -> tuple[list[str], list[str]]:
    """Raise if a target input is absent; return predictors present and missing."""
    lost = [c for c in config.required if c not in df.columns]
    if lost:
        raise SalaryTableInvalid(f"columns needed for the target are missing: {lost}")
    present = [c for c in config.predictors if c in df.columns]
    return present, [c for c in config.predictors if c not in present]


def check_leakage(predictors: Sequence[str], config: SalaryConfig) -> None:
    leaking = sorted(set(predictors) & set(config.leakage))
    if leaking:
        raise SalaryTableInvalid(f"predictors leak the target: {leaking}")


def raw_salary(df: DataFrame, config: SalaryConfig) -> tuple[Column, Column, Column]:
    """Raw value, its source label, and whether any salary field is set."""
    types = dict(df.dtypes)
    low, mid, high = (X.to_double(F.col(c), types[c]) for c in (config.minimum, config.median, config.maximum))
    has_range = (low > 0) & (low <= high)
    value = F.when(has_range, (low + high) / 2).when(mid > 0, mid)
    source = F.when(has_range, F.lit(RANGE_MIDPOINT)).when(mid > 0, F.lit(MEDIAN_SALARY))
    return value, source, F.coalesce(low, mid, high).isNotNull()


def per_year(period: Column, config: SalaryConfig) -> Column:
    """Pay periods per year; null where the period is not supported."""
    text = F.lower(X.utrim(period.cast("string")))
    pairs = [F.lit(x) for pair in config.periods_per_year.items() for x in pair]
    return F.create_map(*pairs)[text]


def add_target(df: DataFrame, config: SalaryConfig) -> DataFrame:
    """Add the target columns and, per row, where it left the funnel.

    The stages are exclusive and tested in order: no salary field at all, no
    usable value, foreign currency, unsupported pay period, out of bounds, kept.
    """
    value, source, any_field = raw_salary(df, config)
    currency = F.coalesce(F.lower(X.utrim(F.col(config.currency).cast("string"))), F.lit(""))
    annual = F.col("_sw_raw") * F.col("_sw_per_year")
    staged = df.withColumns(
        {
            "_sw_raw": value,
            "_sw_source": source,
            "_sw_any": any_field,
            "_sw_per_year": per_year(F.col(config.period), config),
        }
    ).withColumn("_sw_annual", annual)
    status = (
        F.when(~F.col("_sw_any"), "missing")
        .when(F.col("_sw_raw").isNull(), "invalid")
        .when(currency != config.allowed_currency.lower(), "currency")
        .when(F.col("_sw_per_year").isNull(), "pay_period")
        .when(~F.col("_sw_annual").between(config.lower_bound, config.upper_bound), "bounds")
        .otherwise("kept")
    )
    staged = staged.withColumn(_STATUS, status)
    kept = F.col(_STATUS) == "kept"
    return staged.withColumns(
        {
            ANNUAL: F.when(kept, F.col("_sw_annual")),
            LOG: F.when(kept, F.log1p("_sw_annual")),
            SOURCE: F.when(kept, F.col("_sw_source")),
        }
    ).drop("_sw_raw", "_sw_source", "_sw_any", "_sw_per_year", "_sw_annual")


def funnel(with_target: DataFrame) -> DataFrame:
    """Rows in, lost at each stage, kept; the parts add up to the whole."""

    def stage(name: str) -> Column:
        return F.count_if(F.col(_STATUS) == name)

    return with_target.agg(
        F.count(F.lit(1)).alias("rows_in"),
        stage("missing").alias("missing_salary"),
        stage("invalid").alias("invalid_salary"),
        F.count_if(~F.col(_STATUS).isin("missing", "invalid")).alias("candidates"),
        stage("currency").alias("removed_currency"),
        F.count_if(F.col(_STATUS).isin("pay_period", "bounds", "kept")).alias("allowed_currency"),
        stage("pay_period").alias("removed_pay_period"),
        stage("bounds").alias("removed_bounds"),
        stage("kept").alias("kept"),
    )


def log_features(df: DataFrame, names: Sequence[str]) -> dict[str, Column]:
    """``log_<name>``; negative values are null, an absent column is all null."""
    types = dict(df.dtypes)
    null = F.lit(None).cast("double")
    return {
        f"log_{c}": X.log1p_or_null(X.to_double(F.col(c), types[c])) if c in types else null for c in names
    }


def group_id(df: DataFrame, parts: Sequence[str]) -> Column:
    if not parts:
        raise SalaryTableInvalid("no columns configured for the group id")
    return X.group_key([F.col(c) if c in df.columns else F.lit("unknown") for c in parts])


@dataclass(frozen=True)
class SalaryTable:
    staged: DataFrame
    result: DataFrame
    predictors: tuple[str, ...]
    missing_predictors: tuple[str, ...]


def build_salary_table(df: DataFrame, config: SalaryConfig) -> SalaryTable:
    """Target, predictors, log features, group id and metadata of kept rows."""
    check_leakage(config.predictors, config)
    predictors, missing = check_columns(df, config)
    logs = log_features(df, config.log_features)
    staged = add_target(df, config)
    names = dict.fromkeys([ANNUAL, LOG, SOURCE, *predictors, *logs, GROUP, *config.metadata])
    derived = {**logs, GROUP: group_id(df, config.group_parts)}
    kept = staged.filter(F.col(_STATUS) == "kept")
    columns = [
        derived[c].alias(c) if c in derived else F.col(c) for c in names if c in derived or c in staged.columns
    ]
    check_leakage([*predictors, *logs], config)
    return SalaryTable(staged, kept.select(*columns), tuple(predictors), tuple(missing))


def integrity(df: DataFrame, config: SalaryConfig, log_features: Sequence[str] = ()) -> DataFrame:
    """Long report ``(check, violations)``; all must be 0. One pass."""
    infinite = [c for c, t in df.dtypes if t in X.FRACTIONAL]
    is_infinite = F.lit(False)
    for c in infinite:
        is_infinite = is_infinite | F.coalesce(F.abs(c) == float("inf"), F.lit(False))
    checks = {
        "no_rows": F.when(F.count(F.lit(1)) == 0, 1).otherwise(0),
        "null_target": F.count_if(F.col(ANNUAL).isNull() | F.col(LOG).isNull() | F.col(SOURCE).isNull()),
        "target_out_of_bounds": F.count_if(~F.col(ANNUAL).between(config.lower_bound, config.upper_bound)),
        "infinite_value": F.count_if(is_infinite),
        "null_group": F.count_if(F.col(GROUP).isNull()),
        "log_mismatch": F.count_if(F.abs(F.col(LOG) - F.log1p(ANNUAL)) > 1e-9),
        "repeated_or_index_column": F.lit(
            len(df.columns) - len(set(df.columns)) + sum(c.lower() == "index" for c in df.columns)
        ),
    }
    wide = df.agg(F.lit(0).alias("_sw"), *[v.cast("bigint").alias(k) for k, v in checks.items()])
    return wide.unpivot(["_sw"], list(checks), "check", "violations").drop("_sw")


def enforce_integrity(report: DataFrame) -> None:
    """Raise one error that names every failed check. Runs a job."""
    failed = [f"{r['check']}: {r['violations']}" for r in report.filter("violations > 0").collect()]
    if failed:
        raise SalaryTableInvalid("; ".join(failed))


def describe(df: DataFrame, column: str) -> DataFrame:
    """Minimum, maximum, mean, median, sample standard deviation of a column."""
    aggregates = [
        F.count(column).alias("count"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
    ]
    return quantiles.group_statistics(df, [], column, {"median": 0.5}, aggregates)


def label_counts(df: DataFrame, column: str = SOURCE) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def coverage(with_target: DataFrame) -> DataFrame:
    """Share of input rows that have a target, in percent."""
    return with_target.agg(F.avg((F.col(_STATUS) == "kept").cast("double") * 100).alias("coverage"))
