from __future__ import annotations

import pytest

from sievewright import defaults
from sievewright.operators import validate
from sievewright.specs import CanonicalColumn, CanonicalSchema, QualityGate, Reference, TableRules, ValueRule

RULES = TableRules(
    unique_key=("id",),
    not_null=("id", "name"),
    values={"qty": ValueRule(minimum=0, maximum=1000), "status": ValueRule(allowed=("active", "retired"))},
    references=(Reference("warehouse_id", "warehouses", "id"),),
)
TYPES = CanonicalSchema(tuple(CanonicalColumn(c, t) for c, t in (("id", "bigint"), ("name", "string"), ("qty", "bigint"))))
SCHEMA = "id long, name string, qty string, status string, warehouse_id long"
GOOD = [(1, "a", "5", "active", 1), (2, "b", "6", "retired", 2)]


def widgets(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def warehouses(spark, ids=(1, 2)):
    return spark.createDataFrame([(i,) for i in ids], "id long")


def report(spark, data, rules=RULES, schema=SCHEMA, parents=(1, 2), types=TYPES):
    df = widgets(spark, data, schema)
    tables = {"widgets": df}
    if parents is not None:
        tables["warehouses"] = warehouses(spark, parents)
    found = validate.table_report(df, "widgets", rules, tables, types)
    return {(r["check"], r["column"]): r["violations"] for r in found.collect()}


def test_good_table(spark):
    assert report(spark, GOOD) == {("rows", None): 2}


def test_nulls(spark):
    assert report(spark, [(1, None, "5", "active", 1), (2, "b", "6", "active", 1)])[("null", "name")] == 1


def test_structure(spark):
    found = report(spark, [(1, "5", "active", 1)], schema="id long, qty string, status string, warehouse_id long")
    assert {c for k, c in found if k == "structure"} == {"not_null.name", "dtypes.name"}


def test_duplicate_keys(spark):
    data = [(1, "a", "1", "active", 1), (1, "b", "1", "active", 1), (2, "c", "1", "active", 1)]
    assert report(spark, data)[("duplicate_key", "id")] == 2
    sample = validate.duplicate_key_sample(widgets(spark, data), ["id"])
    assert [tuple(r) for r in sample.collect()] == [(1,)]


def test_null_keys_count_as_equal(spark):
    data = [(None, "a", "1", "active", 1), (None, "b", "1", "active", 1)]
    assert report(spark, data)[("duplicate_key", "id")] == 2


def test_key_column_absent(spark):
    found = report(spark, [("a", "1", "active", 1)], schema="name string, qty string, status string, warehouse_id long")
    assert not any(check == "duplicate_key" for check, _ in found)


@pytest.mark.parametrize(
    ("qty", "expected"),
    [(("-5", "2000"), 2), (("0", "1000"), None), ((None, "2"), None), (("not_a_number", "5"), None)],
)
def test_range(spark, qty, expected):
    data = [(i, "n", q, "active", 1) for i, q in enumerate(qty)]
    assert report(spark, data).get(("value", "qty")) == expected


def test_domain(spark):
    data = [(1, "a", "1", "active", 1), (2, "b", "1", "discontinued", 1), (3, "c", "1", None, 1)]
    assert report(spark, data)[("value", "status")] == 1


def test_pattern_is_anchored_at_the_start(spark):
    rules = TableRules(values={"name": ValueRule(pattern=r"widget-\d+")})
    data = [(1, "widget-1x", "1", "a", 1), (2, "not-a-widget-1", "1", "a", 1)]
    assert report(spark, data, rules)[("value", "name")] == 1


def test_several_broken_parts_count_once(spark):
    rules = TableRules(values={"name": ValueRule(allowed=("x",), pattern="y")})
    assert report(spark, [(1, "z", "1", "a", 1)], rules)[("value", "name")] == 1


def test_conformance_leaves_the_input(spark):
    data = [(1, "a", "1", "active", 1), (2, "b", "not_a_number", "active", 1)]
    assert report(spark, data)[("dtype", "qty")] == 1
    assert widgets(spark, data).collect()[1]["qty"] == "not_a_number"


def test_broken_reference(spark):
    data = [(1, "a", "1", "active", 1), (2, "b", "1", "active", 999), (3, "c", "1", "active", None)]
    assert report(spark, data, parents=(1,))[("reference", "warehouse_id")] == 1


def test_parent_absent(spark):
    assert report(spark, GOOD, parents=None) == {("rows", None): 2}
    assert validate.skipped_references({"widgets": widgets(spark, GOOD)}, {"widgets": RULES}) == [("widgets", "warehouse_id")]


def test_null_references_pass(spark):
    assert report(spark, [(1, "a", "1", "active", None)], parents=(1,)) == {("rows", None): 1}


def corpus(spark):
    tables = {
        "widgets": widgets(spark, [(1, "a", "1", "active", 1), (1, "b", "-1", "active", 7)]),
        "warehouses": warehouses(spark),
        "unmodelled": spark.createDataFrame([(1,)], "x long"),
    }
    rules = {"widgets": RULES, "warehouses": TableRules(unique_key=("id",))}
    return validate.validate(tables, rules, {"widgets": TYPES})


def test_summary_and_verdicts(spark):
    verdicts = {r["table"]: (r["rows"], r["rules_defined"], r["passed"]) for r in validate.table_verdicts(corpus(spark)).collect()}
    assert verdicts == {"widgets": (2, True, False), "warehouses": (2, True, True), "unmodelled": (1, False, True)}
    row = validate.summary(corpus(spark)).first()
    assert (row["tables_passed"], row["tables_failed"], row["tables_skipped"]) == (1, 1, 1)
    assert (row["duplicate_key_rows"], row["invalid_values"], row["broken_references"]) == (2, 1, 1)


GATES = {
    "duplicate_keys": "2 duplicate key rows",
    "invalid_values": "1 invalid values",
    "broken_references": "1 broken references",
}


@pytest.mark.parametrize("flag", list(GATES))
def test_gate(spark, flag):
    summary = validate.summary(corpus(spark))
    with pytest.raises(validate.QualityGateFailed, match=GATES[flag]):
        validate.enforce(summary, QualityGate(**{flag: True}))


def test_gate_passes(spark):
    summary = validate.summary(corpus(spark))
    validate.enforce(summary, QualityGate())
    validate.enforce(summary, QualityGate(nulls=True, structure=True, dtype_conformance=True))


def test_gate_names_everything(spark):
    with pytest.raises(validate.QualityGateFailed) as error:
        validate.enforce(validate.summary(corpus(spark)), QualityGate(*[True] * 6))
    assert all(text in str(error.value) for text in GATES.values())


def test_default_rules(spark):
    for table, rules in defaults.VALIDATION_RULES.items():
        for reference in rules.references:
            assert reference.parent_column in defaults.SCHEMAS[reference.parent].names
            assert reference.column in defaults.SCHEMAS[table].names
    postings = spark.createDataFrame(
        [(1, 10, "a", 50000.0), (2, 999, "b", -1.0)], "job_id long, company_id long, title string, min_salary double"
    )
    companies = spark.createDataFrame([(10, "c")], "company_id long, name string")
    tables = {"postings": postings, "companies": companies}
    found = validate.table_report(postings, "postings", defaults.VALIDATION_RULES["postings"], tables)
    counts = {(r["check"], r["column"]): r["violations"] for r in found.collect()}
    assert counts[("reference", "company_id")] == 1
    assert counts[("value", "min_salary")] == 1


def test_scope_keeps_versions_apart(spark):
    df = spark.createDataFrame([(1, "v1"), (1, "v2"), (2, "v2"), (2, "v2")], "id long, v string")
    found = validate.table_report(df, "t", TableRules(unique_key=("id",)), {"t": df}, scope=("v",))
    counts = {(r["v"], r["check"]): r["violations"] for r in found.collect()}
    assert counts == {("v1", "rows"): 1, ("v2", "rows"): 3, ("v2", "duplicate_key"): 2}


def test_row_rules_scan_the_table_once(spark, tmp_path):
    widgets(spark, GOOD).write.parquet(str(tmp_path / "w"))
    df = spark.read.parquet(str(tmp_path / "w"))
    plan = validate.row_checks(df, "widgets", RULES, TYPES)._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("FileScan") == 1
