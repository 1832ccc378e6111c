from __future__ import annotations

import pytest

from sievewright.operators import master
from sievewright.specs import BridgeJoin, DimensionJoin, SnapshotJoin

FACT = [(1, 10, "a"), (2, 20, "b"), (3, None, "c"), (4, 99, "d")]


def fact(spark):
    return spark.createDataFrame(FACT, "job_id long, company_id long, title string")


def result(state, *columns):
    return [tuple(r) for r in state.result.orderBy("job_id").select(*columns).collect()]


def test_dimension_with_duplicates_and_collision(spark):
    companies = spark.createDataFrame(
        [(10, "x", "clash", 1), (10, "y", "clash", 2), (20, "z", "clash", 3)], "company_id long, name string, title string, _i long"
    )
    spec = DimensionJoin("companies", "company_id", "company_id", rename={"name": "company_name"})
    state = master.build_master(fact(spark), {"companies": companies}, [spec], order_by=("_i",))
    assert result(state, "company_name", "title") == [("x", "a"), ("z", "b"), (None, "c"), (None, "d")]
    assert state.created == ("company_name",) and state.dropped == ("companies.title",)
    last = DimensionJoin("companies", "company_id", "company_id", rename={"name": "company_name"}, keep="last")
    state = master.build_master(fact(spark), {"companies": companies}, [last], order_by=("_i",))
    assert result(state, "company_name")[0] == ("y",)


def test_only_wanted_columns(spark):
    companies = spark.createDataFrame([(10, "x", "s")], "company_id long, name string, state string")
    spec = DimensionJoin("companies", "company_id", "company_id", output=("state",))
    state = master.build_master(fact(spark), {"companies": companies}, [spec])
    assert state.created == ("state",)


def test_snapshot_takes_the_newest_with_ties_and_gaps(spark):
    counts = spark.createDataFrame(
        [(10, 5, 100.0, 1), (10, 6, 200.0, 2), (10, 7, 200.0, 3), (20, 8, None, 4), (20, 9, 1.0, 5)],
        "company_id long, n long, t double, _i long",
    )
    spec = SnapshotJoin("counts", "company_id", "company_id", latest_by="t")
    state = master.build_master(fact(spark), {"counts": counts}, snapshots=[spec], order_by=("_i",))
    assert result(state, "n") == [(6,), (9,), (None,), (None,)]
    first = SnapshotJoin("counts", "company_id", "company_id")
    state = master.build_master(fact(spark), {"counts": counts}, snapshots=[first], order_by=("_i",))
    assert result(state, "n") == [(5,), (8,), (None,), (None,)]


def bridge(spark):
    eleven = [(1, f"v{i:02d}") for i in range(11)]
    ties = [(2, "b"), (2, "a"), (2, "b"), (2, "a"), (2, None), (None, "a")]
    return spark.createDataFrame(eleven + ties, "job_id long, v string")


def test_bridge(spark):
    state = master.build_master(fact(spark), {"b": bridge(spark)}, bridges=[BridgeJoin("b", "job_id", "v", "x")])
    rows = result(state, "x_count", "top_x", "x_list")
    assert rows[0] == (11, "v00", [f"v{i:02d}" for i in range(10)])
    assert rows[1] == (2, "a", ["a", "b"])
    assert rows[2] == (0, None, None)


def test_bridge_lookup_does_not_multiply(spark):
    pairs = spark.createDataFrame([(1, 7), (1, 8), (1, 8), (1, 9)], "job_id long, k long")
    names = spark.createDataFrame([(7, "seven"), (7, "seven"), (7, "seven"), (8, "eight")], "k long, name string")
    spec = BridgeJoin("pairs", "job_id", "k", "x", "names", "k", "name")
    state = master.build_master(fact(spark), {"pairs": pairs, "names": names}, bridges=[spec])
    assert result(state, "x_count", "top_x", "x_list")[0] == (2, "eight", ["eight", "seven"])
    raw = master.build_master(fact(spark), {"pairs": pairs}, bridges=[spec])
    assert result(raw, "x_count", "top_x")[0] == (3, 8)


def test_skipped_statistics_and_integrity(spark):
    companies = spark.createDataFrame([(10, "x")], "company_id long, name string")
    specs = [
        DimensionJoin("companies", "company_id", "company_id"),
        DimensionJoin("absent", "company_id", "k"),
        DimensionJoin("companies", "company_id", "company_id", enabled=False),
    ]
    state = master.build_master(fact(spark), {"companies": companies}, specs)
    assert state.skipped == ("absent", "companies")
    row = master.match_statistics(state).first()
    assert (row["rows_matched"], row["rows_unmatched"], row["match_rate"]) == (1, 3, 0.25)
    assert master.column_coverage(state).first()["coverage"] == 25.0
    master.enforce_integrity(master.integrity_counts(fact(spark), state.result, "job_id"))


@pytest.mark.parametrize(("data", "message"), [(FACT[:3], "row count"), ([*FACT[:3], (3, 1, "x")], "not unique"), ([*FACT[:3], (None, 1, "x")], "no key")])
def test_integrity_fails(spark, data, message):
    broken = spark.createDataFrame(data, "job_id long, company_id long, title string")
    with pytest.raises(master.IntegrityError, match=message):
        master.enforce_integrity(master.integrity_counts(fact(spark), broken, "job_id"))


def test_unknown_left_key(spark):
    companies = spark.createDataFrame([(10, "x")], "company_id long, name string")
    with pytest.raises(ValueError, match="no column nope"):
        master.build_master(fact(spark), {"companies": companies}, [DimensionJoin("companies", "nope", "company_id")])


def test_union_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id long, only_a string")
    b = spark.createDataFrame([(1, "y")], "id long, only_b string")
    out = master.union_versions({"Version_1": a, "Version_2": b})
    got = sorted(tuple(r) for r in out.select("dataset_version", "id", "only_a", "only_b").collect())
    assert got == [("Version_1", 1, "x", None), ("Version_2", 1, None, "y")]


def test_hot_key_keeps_every_row(spark):
    """A third of the facts share one key, another third have none."""
    df = spark.range(3000).selectExpr("id as job_id", "case id % 3 when 0 then 7 when 1 then null else id end as company_id")
    companies = spark.range(0, 3000, 2).selectExpr("id as company_id", "concat('c', id) as name").unionByName(
        spark.createDataFrame([(7, "seven")], "company_id long, name string")
    )
    state = master.build_master(df, {"companies": companies}, [DimensionJoin("companies", "company_id", "company_id")])
    counts = state.result.selectExpr("count(*) n", "count_if(name = 'seven') s", "count_if(company_id is null) u").first()
    assert tuple(counts) == (3000, 1000, 1000)
