from __future__ import annotations

import dataclasses
import math

import pytest

from pyspark.sql import functions as F

from sievewright import defaults
from sievewright.operators import features, fingerprint, target
from sievewright.specs import FeatureConfig, SalaryConfig

# ------------------------------------------------------------------- features


def test_column_kinds(spark):
    df = spark.createDataFrame([(1, 1.0, "a", 5, "x")], "job_id long, listed_time double, title string, views long, note string")
    kinds = features.column_kinds(df, defaults.FEATURES)
    assert kinds == {"job_id": "identifier", "listed_time": "datetime", "title": "text", "views": "number", "note": "other"}
    # the first declaration counts, and declarations go before types
    both = FeatureConfig(lists=("views",), numbers=("views", "note"))
    assert features.column_kinds(df, both)["views"] == "list" and features.column_kinds(df, both)["note"] == "number"
    assert "views" not in features.fill_plan(df, both)


def test_schema_fingerprints(spark):
    a = spark.createDataFrame([(1, "x")], "a long, b string")
    b = a.select("b", "a")
    assert features.schema_fingerprint(a) == features.schema_fingerprint(b)
    assert features.schema_fingerprint(a, "sorted_json") == features.schema_fingerprint(b, "sorted_json")
    assert features.schema_fingerprint(a, "ordered_json") != features.schema_fingerprint(b, "ordered_json")
    assert not features.schema_drift(b, features.schema_fingerprint(a))
    assert features.schema_drift(a.withColumnRenamed("a", "c"), features.schema_fingerprint(a))


def test_fill_strategies(spark):
    df = spark.createDataFrame(
        [(1, "b", None, None), (None, "a", 1.0, "k"), (4, None, 2.0, None), (5, "a", None, None), (None, "b", None, None)],
        "m long, c string, l double, u string",
    )
    config = FeatureConfig(fill_strategies={"l": "leave", "u": "constant"})
    rows = [tuple(r) for r in features.fill_missing(df, config).collect()]
    # a and b tie as mode: the smaller one wins
    assert rows == [(1.0, "b", None, "UNKNOWN"), (4.0, "a", 1.0, "k"), (4.0, "a", 2.0, "UNKNOWN"), (5.0, "a", None, "UNKNOWN"), (4.0, "b", None, "UNKNOWN")]


def test_mode_is_skipped_over_many_values(spark):
    df = spark.range(102).selectExpr("case when id > 0 then concat('v', id) end as c")
    filled = features.fill_missing(df, FeatureConfig())
    assert filled.filter("c is null").count() == 1
    assert features.fill_missing(df, FeatureConfig(mode_max_distinct=200)).filter("c is null").count() == 0


def test_modes_keep_the_type_of_their_column(spark):
    """Ties by value, not by text; the limit is for texts and times only."""
    rows = [(9.0, i, f"2024-01-{1 + i % 28:02}", f"t{i % 7}") for i in range(150)]
    rows += [(10.0, 7, "2024-01-05", "t3")] * 150 + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "tied double, many long, day string, text string").withColumn("day", F.to_timestamp("day"))
    config = FeatureConfig(numeric_strategy="mode")
    filled = features.fill_missing(df, config)
    assert filled.dtypes == df.dtypes
    last = [r for r in filled.collect() if r.tied is not None][-1]
    assert (last.tied, last.many, str(last.day)[:10], last.text) == (9.0, 7, "2024-01-05", "t3")
    few = features.fill_missing(df, FeatureConfig(numeric_strategy="mode", mode_max_distinct=10))
    assert few.filter("day is null").count() == 1 and few.filter("text is null or many is null or tied is null").count() == 0


def test_constants_and_unknown_strategy(spark):
    df = spark.createDataFrame([(None, None, None), (1.0, 2.0, "x")], "size double, n double, t string")
    config = FeatureConfig(
        fill_strategies={"size": "constant", "n": "constant", "t": "no_such"}, fill_constants={"size": "UNKNOWN"}
    )
    assert [tuple(r) for r in features.fill_missing(df, config).collect()] == [("UNKNOWN", -1.0, None), ("1.0", 2.0, "x")]


STORE = FeatureConfig(
    identifiers=("job_id",),
    booleans=("remote",),
    texts=("description",),
    lists=("skill_list",),
    presence_flags={"has_description": ("description",)},
    list_counts={"skill_count": "skill_list"},
    fill_strategies={"skill_count": "leave"},
)


def postings(spark):
    many = [f"d{i}" for i in range(101)]
    rows = [(0, None, None, 12, ["b", "a", "a"]), (1, 1.0, "x", 0, None), (2, 0.0, "x ", 1, ["z"])]
    rows += [(3 + i, 1.0, d, 1, ["z"]) for i, d in enumerate(many)]
    return spark.createDataFrame(rows, "job_id long, remote double, description string, skill_count long, skill_list array<string>")


def test_store_keeps_what_is_known(spark):
    build = features.build_features(postings(spark), STORE)
    first = build.before_dedupe.filter("skill_list = 'A|B'").first()
    assert first["remote"] is None and first["has_description"] is False and first["description"] is None
    assert (first["skill_count"], first["skill_count_listed"]) == (12, 2)
    assert "job_id" not in build.result.columns


def test_store_parity(spark):
    build = features.build_features(postings(spark), dataclasses.replace(STORE, parity=True))
    first = build.before_dedupe.filter("skill_list = 'A|B'").first()
    # filled by the median before conversion, missing text became a word, count replaced
    assert (first["remote"], first["has_description"], first["description"], first["skill_count"]) == (True, True, "<NA>", 2)


def test_store_validation(spark):
    build = features.build_features(postings(spark), STORE)
    assert features.validate_features(build.result, STORE) == []
    with pytest.raises(features.FeatureStoreInvalid, match="empty"):
        features.validate_features(build.result.filter("false"), STORE)
    with pytest.raises(features.FeatureStoreInvalid, match="has_description"):
        features.validate_features(build.result.drop("has_description"), STORE)
    with pytest.raises(features.FeatureStoreInvalid, match="repeated"):
        features.validate_features(build.result.select("*", "remote"), STORE)
    assert features.missing_expected(build.result.drop("remote"), STORE) == ["remote"]


def test_store_summary(spark):
    row = features.feature_summary(features.build_features(postings(spark), STORE)).first()
    assert row["rows_before"] == 104 and row["rows_removed"] == 0
    assert row["nulls_before"] == 3 and row["cells_filled"] == 0


def test_duplicates_on_a_subset(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    assert features.drop_duplicates(df, FeatureConfig(duplicate_subset=("k",))).count() == 1
    assert features.drop_duplicates(df, FeatureConfig(drop_duplicates=False)).count() == 2


# --------------------------------------------------------------------- target

SALARY = defaults.SALARY
COLUMNS = "min_salary double, med_salary double, max_salary double, pay_period string, currency string"
CASES = [
    ((50.0, None, 70.0, " Hourly ", "usd"), "kept", 124800.0),
    ((0.0, None, 10.0, "yearly", "usd"), "invalid", None),
    ((90000.0, 85000.0, 80000.0, "YEARLY", " USD "), "kept", 85000.0),
    ((None, -1.0, None, "yearly", "usd"), "invalid", None),
    ((None, None, None, "yearly", "usd"), "missing", None),
    ((50000.0, None, 60000.0, "once", "usd"), "pay_period", None),
    ((50000.0, None, 60000.0, None, "usd"), "pay_period", None),
    ((50000.0, None, 60000.0, "yearly", "eur"), "currency", None),
    ((50000.0, None, 60000.0, "yearly", None), "currency", None),
    ((None, 9999.99, None, "yearly", "usd"), "bounds", None),
    ((None, 10000.0, None, "yearly", "usd"), "kept", 10000.0),
    ((None, 1000000.0, None, "yearly", "usd"), "kept", 1000000.0),
    ((None, 1000000.01, None, "yearly", "usd"), "bounds", None),
    ((None, 500.0, None, "biweekly", "usd"), "kept", 13000.0),
]


def salaries(spark):
    data = [(i, *c[0], "Dev", "Acme", "NY", 10 - i) for i, c in enumerate(CASES)]
    return spark.createDataFrame(
        data, f"i int, {COLUMNS}, title string, company_name string, location string, company_employee_count long"
    )


def test_target_cases(spark):
    rows = target.add_target(salaries(spark), SALARY).orderBy("i").collect()
    for row, (_, status, annual) in zip(rows, CASES):
        assert row["_sw_status"] == status, row
        assert row[target.ANNUAL] == (pytest.approx(annual) if annual else None)
        assert row[target.LOG] == (pytest.approx(math.log1p(annual)) if annual else None)
    assert rows[0][target.SOURCE] == "RANGE_MIDPOINT" and rows[2][target.SOURCE] == "MEDIAN_SALARY"


def test_funnel_adds_up(spark):
    row = target.funnel(target.add_target(salaries(spark), SALARY)).first()
    lost = ("missing_salary", "invalid_salary", "removed_currency", "removed_pay_period", "removed_bounds", "kept")
    assert row["rows_in"] == len(CASES) == sum(row[c] for c in lost)
    assert row["candidates"] == row["removed_currency"] + row["allowed_currency"]


def test_salary_table(spark):
    built = target.build_salary_table(salaries(spark), SALARY)
    out = built.result
    assert out.columns[:4] == [target.ANNUAL, target.LOG, target.SOURCE, "title"]
    assert not set(built.predictors) & set(SALARY.leakage)
    assert "top_skill" in built.missing_predictors
    logs = {r["company_employee_count"]: r["log_company_employee_count"] for r in out.collect()}
    assert logs[10] == pytest.approx(math.log1p(10)) and logs[-1] is None
    target.enforce_integrity(target.integrity(out, SALARY))
    assert out.select(target.GROUP).distinct().count() == 1


def test_integrity_finds_faults(spark):
    out = target.build_salary_table(salaries(spark), SALARY).result
    broken = out.selectExpr(
        f"5.0D as {target.ANNUAL}", f"{target.LOG}", target.SOURCE, f"cast(null as string) as {target.GROUP}",
        "double('Infinity') as x", "1 as index"
    )
    with pytest.raises(target.SalaryTableInvalid) as error:
        target.enforce_integrity(target.integrity(broken, SALARY))
    for check in ("target_out_of_bounds", "null_group", "infinite_value", "log_mismatch", "repeated_or_index_column"):
        assert check in str(error.value)
    with pytest.raises(target.SalaryTableInvalid, match="no_rows"):
        target.enforce_integrity(target.integrity(out.filter("false"), SALARY))


def test_guards(spark):
    with pytest.raises(target.SalaryTableInvalid, match="currency"):
        target.check_columns(salaries(spark).drop("currency"), SALARY)
    leaking = dataclasses.replace(SALARY, predictors=("title", "views"))
    with pytest.raises(target.SalaryTableInvalid, match="views"):
        target.build_salary_table(salaries(spark), leaking)
    with pytest.raises(target.SalaryTableInvalid):
        target.group_id(salaries(spark), ())
    assert SalaryConfig().required == SALARY.required


def test_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (6.0,), (None,)], "v double")
    row = target.describe(df, "v").first().asDict()
    assert row == {"count": 3, "min": 1.0, "max": 6.0, "mean": 3.0, "median": 2.0, "std": pytest.approx(7**0.5)}


# ---------------------------------------------------------------- fingerprints


def test_fingerprint_ignores_order_but_not_content(spark):
    df = spark.createDataFrame(
        [("a", 1, None, ["x"]), ("a", None, 1, ["x"]), ("b", 2, 2, None)], "p string, x long, y long, l array<string>"
    )
    base = fingerprint.content_fingerprint(df, ["p"])
    assert fingerprint.is_unchanged(fingerprint.content_fingerprint(df.repartition(3), ["p"]), base, ["p"])
    swapped = df.selectExpr("p", "y as x", "x as y", "l")
    one = df.filter("x = 1")
    other = one.selectExpr("p", "y as x", "x as y", "l")
    assert not fingerprint.is_unchanged(
        fingerprint.content_fingerprint(other, ["p"]), fingerprint.content_fingerprint(one, ["p"]), ["p"]
    )
    assert swapped.count() == 3
    doubled = fingerprint.content_fingerprint(df.unionByName(df), ["p"])
    assert {r["status"] for r in fingerprint.changes(doubled, base, ["p"]).collect()} == {"changed"}
    statuses = {
        r["p"]: r["status"]
        for r in fingerprint.changes(
            fingerprint.content_fingerprint(df.filter("p = 'a'"), ["p"], "new config"),
            base,
            ["p"],
        ).collect()
    }
    assert statuses == {"a": "changed", "b": "gone"}
