from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sievewright import defaults
from sievewright.operators import clean, dedupe
from sievewright.specs import (
    CanonicalColumn,
    CanonicalSchema,
    CleaningRule,
    DuplicatePolicy,
    InvalidValuePolicy,
    NullPolicy,
    OrphanPolicy,
    Reference,
)

TABLES = {
    "companies": ("company_id long, name string", [(1, " Google "), (2, None)]),
    "postings": (
        "job_id long, company_id long, title string",
        [
            (101, 1, " Senior Software Engineer "),
            (102, 2, "Data  Scientist"),
            (103, None, "DevOps"),
            (104, 999, " Designer "),
        ],
    ),
    "job_skills": ("job_id long, skill_abr string", [(101, "ENG"), (102, "IT"), (8888, "MKT")]),
    "industries": ("industry_id long, industry_name string", [(10, " TECHNOLOGY "), (20, "HEALTHCARE")]),
    "skills": ("skill_abr string, skill_name string", [("ENG", "Engineering"), ("IT", "Information Technology")]),
}


def numbered(spark, name, data=None, schema=None):
    schema = schema or TABLES[name][0]
    data = data if data is not None else TABLES[name][1]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(data)], f"{schema}, _ingest_id long")


def run(spark, rules=defaults.CLEANING_RULES, schemas=None, **changes):
    tables = {n: numbered(spark, n) for n in TABLES} | changes
    cleaned, failed = clean.clean_all(tables, rules, schemas, order_by=("_ingest_id",))
    assert not failed
    return cleaned


def values(df, column, order="_ingest_id"):
    return [r[0] for r in df.orderBy(order).select(column).collect()]


def test_strings(spark):
    cleaned = run(spark)
    assert values(cleaned["postings"].result, "title") == ["Senior Software Engineer", "Data Scientist"]
    assert values(cleaned["industries"].result, "industry_name") == ["technology", "healthcare"]


def test_lowercase_is_by_whole_name(spark):
    assert values(run(spark)["skills"].result, "skill_name") == ["engineering", "information technology"]
    assert values(run(spark)["skills"].result, "skill_abr") == ["ENG", "IT"]


def test_empty_text_is_filled(spark):
    companies = numbered(spark, "companies", [(1, "Google"), (2, "   "), (3, "")])
    cleaned = run(spark, companies=companies)
    assert values(cleaned["companies"].result, "name") == ["Google", "Unknown Company", "Unknown Company"]


def test_null_key_rows_are_dropped(spark):
    assert None not in values(run(spark)["postings"].result, "company_id")


@pytest.mark.parametrize(
    ("policy", "rows", "nulls"),
    [(InvalidValuePolicy.DROP_ROW, 2, 0), (InvalidValuePolicy.NULLIFY, 3, 1), (InvalidValuePolicy.LEAVE, 3, 0)],
)
def test_bounds(spark, policy, rows, nulls):
    df = spark.createDataFrame([(60000.0,), (-500.0,), (90000.0,)], "med_salary double")
    out = clean.handle_invalid(df, CleaningRule(minimums={"med_salary": 0.0}, invalid_values=policy)).collect()
    assert len(out) == rows
    assert sum(r[0] is None for r in out) == nulls


@pytest.mark.parametrize(
    ("policy", "expected"),
    [
        (DuplicatePolicy.KEEP_FIRST, ["first", "unique"]),
        (DuplicatePolicy.KEEP_LAST, ["second", "unique"]),
        (DuplicatePolicy.DROP_ALL, ["unique"]),
    ],
)
def test_duplicates(spark, policy, expected):
    df = numbered(spark, "x", [(1, "first"), (1, "second"), (2, "unique")], "id long, v string")
    out = clean.remove_duplicates(df, CleaningRule(key=("id",), duplicates=policy), ("_ingest_id",))
    assert values(out, "v") == expected


def test_whole_row_duplicates(spark):
    df = numbered(spark, "x", [(1, None), (1, None), (1, "a")], "id long, v string")
    assert values(clean.remove_duplicates(df, CleaningRule(), ("_ingest_id",)), "_ingest_id") == [0, 2]


def test_mixed_keys_become_one(spark):
    df = numbered(spark, "x", [("101",), ("101.0",), (" 101",)], "id string")
    cleaned = clean.clean_table(
        df, "x", CleaningRule(key=("id",)), {}, CanonicalSchema((CanonicalColumn("id", "bigint"),)), ("_ingest_id",)
    )
    assert values(cleaned.result, "id") == [101]
    assert dict(cleaned.result.dtypes)["id"] == "bigint"


def test_orphans(spark):
    cleaned = run(spark)
    assert 999 not in values(cleaned["postings"].result, "company_id")
    assert values(cleaned["job_skills"].result, "job_id") == [101, 102]


def test_orphans_can_stay(spark):
    rule = CleaningRule(references=(Reference("company_id", "companies", "company_id"),), orphans=OrphanPolicy.LEAVE)
    out = clean.remove_orphans(numbered(spark, "postings"), rule, {"companies": numbered(spark, "companies")})
    assert 999 in values(out, "company_id")


def test_orphan_check_uses_the_cleaned_parent(spark):
    # posting 103 is dropped, so its skill is an orphan
    skills = numbered(spark, "job_skills", [(103, "ENG"), (101, "ENG")])
    assert values(run(spark, job_skills=skills)["job_skills"].result, "job_id") == [101]


def test_null_reference_survives(spark):
    rule = CleaningRule(references=(Reference("company_id", "companies", "company_id"),))
    out = clean.remove_orphans(numbered(spark, "postings"), rule, {"companies": numbered(spark, "companies")})
    assert values(out, "job_id") == [101, 102, 103]


def test_missing_parent_skips(spark):
    rule = CleaningRule(references=(Reference("company_id", "companies", "company_id"),))
    assert clean.remove_orphans(numbered(spark, "postings"), rule, {}).count() == 4


def test_one_broken_table(spark):
    tables = {"good": numbered(spark, "x", [(1,)], "id long"), "bad": numbered(spark, "x", [(1,)], "id long")}
    rules = {"bad": CleaningRule(key=("no_such_column",))}
    cleaned, failed = clean.clean_all(tables, rules, order_by=("_ingest_id",))
    assert list(cleaned) == ["good"] and list(failed) == ["bad"]
    with pytest.raises(Exception):
        clean.clean_all(tables, rules, order_by=("_ingest_id",), continue_on_error=False)


def test_report(spark):
    reports = {n: clean.cleaning_report(c).first() for n, c in run(spark).items()}
    postings = reports["postings"]
    assert (postings["rows_before"], postings["rows_after"]) == (4, 2)
    assert (postings["null_rows_dropped"], postings["orphan_rows_removed"], postings["strings_modified"]) == (1, 1, 3)
    assert reports["companies"]["nulls_filled"] == 1


@pytest.mark.parametrize("policy", list(InvalidValuePolicy))
def test_report_of_bounds(spark, policy):
    df = numbered(spark, "x", [(1.0, -1.0), (-1.0, -1.0), (1.0, 1.0)], "a double, b double")
    rule = CleaningRule(minimums={"a": 0, "b": 0}, invalid_values=policy)
    row = clean.cleaning_report(clean.clean_table(df, "x", rule, {}, order_by=("_ingest_id",))).first()
    expected = {InvalidValuePolicy.DROP_ROW: 2, InvalidValuePolicy.NULLIFY: 3, InvalidValuePolicy.LEAVE: 0}
    assert row["invalid_values_handled"] == expected[policy]


def test_second_pass_changes_nothing(spark):
    first = run(spark)
    tables = {n: c.result for n, c in first.items()}
    second, _ = clean.clean_all(tables, defaults.CLEANING_RULES, order_by=("_ingest_id",))
    for name, table in second.items():
        row = clean.cleaning_report(table).first()
        assert row["rows_before"] == row["rows_after"], name
        assert (row["nulls_filled"], row["strings_modified"], row["duplicates_removed"]) == (0, 0, 0), name


def test_input_is_not_changed(spark):
    tables = {n: numbered(spark, n) for n in TABLES}
    before = {n: df.collect() for n, df in tables.items()}
    cleaned, _ = clean.clean_all(tables, defaults.CLEANING_RULES, order_by=("_ingest_id",))
    for name in cleaned:
        cleaned[name].result.collect()
        assert tables[name].collect() == before[name]


def test_parents_come_first():
    order = clean.parents_first(["job_skills", "postings", "skills", "companies"], defaults.CLEANING_RULES)
    assert order.index("companies") < order.index("postings") < order.index("job_skills")
    cycle = {
        "a": CleaningRule(references=(Reference("x", "b", "x"),)),
        "b": CleaningRule(references=(Reference("x", "a", "x"),)),
    }
    with pytest.raises(ValueError, match="cycle"):
        clean.parents_first(["a", "b"], cycle)


def test_keep_first_reduces_before_the_shuffle(spark):
    """A hot key sends one row per task: the limit sits below the exchange."""
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedupe.first_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning(k")[1]
    assert "WindowGroupLimit" in below


def test_null_policy_leave(spark):
    df = numbered(spark, "companies")
    assert clean.handle_nulls(df, CleaningRule(null_policies={"name": NullPolicy.LEAVE})).count() == 2
