from __future__ import annotations

import pytest

from sievewright import defaults
from sievewright.operators import align
from sievewright.specs import CanonicalColumn, CanonicalSchema

WIDGETS = CanonicalSchema(
    (
        CanonicalColumn("id", "bigint", ("id", "widget_id"), required=True),
        CanonicalColumn("name", "string"),
        CanonicalColumn("qty", "bigint", ("qty", "quantity")),
    )
)


def test_alias(spark):
    df = spark.createDataFrame([(1, "a", 2)], "widget_id long, name string, qty long")
    out, report = align.align(df, WIDGETS)
    assert out.columns == ["id", "name", "qty"]
    assert report.renamed == {"id": "widget_id"}


def test_names_ignore_case(spark):
    df = spark.createDataFrame([(1, "a", 2)], "ID long, NAME string, QTY long")
    out, report = align.align(df, WIDGETS)
    assert out.columns == ["id", "name", "qty"]
    assert set(report.renamed) == {"id", "name", "qty"}


def test_first_candidate_wins(spark):
    df = spark.createDataFrame([(1, 9, "a")], "widget_id long, id long, name string")
    out, report = align.align(df, WIDGETS)
    assert out.first()["id"] == 9
    assert report.unmapped == ("widget_id",)


def test_order_follows_the_schema(spark):
    df = spark.createDataFrame([(2, "a", 1)], "qty long, name string, id long")
    assert align.align(df, WIDGETS)[0].columns == ["id", "name", "qty"]


@pytest.mark.parametrize("keep", [True, False])
def test_unmapped(spark, keep):
    df = spark.createDataFrame([(1, "a", 2, "x")], "id long, name string, qty long, warehouse_notes string")
    out, report = align.align(df, WIDGETS, keep_unmapped=keep)
    assert ("unmapped__warehouse_notes" in out.columns) is keep
    assert report.unmapped == ("warehouse_notes",)


def test_required_missing(spark):
    df = spark.createDataFrame([("a",)], "name string")
    with pytest.raises(align.MissingColumns, match="id"):
        align.align(df, WIDGETS)


def test_required_but_empty_is_reported_only(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b")], "id long, name string")
    out, _ = align.align(df, WIDGETS)
    assert [r["column"] for r in align.empty_required(out, WIDGETS).collect()] == ["id"]


def test_optional_missing_is_a_typed_null(spark):
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    out, report = align.align(df, WIDGETS)
    assert dict(out.dtypes)["qty"] == "bigint"
    assert out.first()["qty"] is None
    assert report.missing == ("qty",)


def test_missing_without_type(spark):
    schema = CanonicalSchema((CanonicalColumn("id", "bigint"), CanonicalColumn("notes")))
    out, _ = align.align(spark.createDataFrame([(1,)], "id long"), schema)
    assert out.first()["notes"] is None


def test_no_schema_passes(spark):
    df = spark.createDataFrame([(1,)], "anything long")
    out, report = align.align(df, None)
    assert out.columns == ["anything"]
    assert not report.known and report.unmapped == ("anything",)


def test_own_columns_pass(spark):
    df = spark.createDataFrame([(1, "v1")], "id long, dataset_version string")
    out, report = align.align(df, WIDGETS, passthrough=("dataset_version",))
    assert out.columns == ["id", "name", "qty", "dataset_version"]
    assert report.unmapped == ()


def test_default_schemas(spark):
    df = spark.createDataFrame([(5, 1, "t")], "id long, company_id long, title string")
    out, report = align.align(df, defaults.SCHEMAS["postings"])
    assert out.first()["job_id"] == 5
    assert report.renamed == {"job_id": "id"}
    assert len(defaults.SCHEMAS) == 10
    for schema in defaults.SCHEMAS.values():
        assert len(set(schema.names)) == len(schema.names)
        assert any(c.required for c in schema.columns)


def test_align_all_and_summary(spark):
    tables = {
        "widgets": spark.createDataFrame([(1, "a", "x")], "widget_id long, name string, extra string"),
        "other": spark.createDataFrame([(1,)], "k long"),
    }
    aligned, reports = align.align_all(tables, {"widgets": WIDGETS})
    long = align.alignment_report(tables["widgets"], "widgets", reports["widgets"]).unionByName(
        align.alignment_report(tables["other"], "other", reports["other"])
    )
    row = align.alignment_summary(long).first()
    assert row.asDict() == {"tables": 2, "renamed": 1, "missing": 1, "unmapped": 2}
    assert aligned["other"].columns == ["k"]
