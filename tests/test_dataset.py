"""Sources, sinks and the two end-to-end plans on a small two-version dump."""

from __future__ import annotations

import csv
import json

import pytest
from pyspark.sql import functions as F

from sievewright import defaults
from sievewright.operators import validate
from sievewright.plans import dataset
from sievewright.sources import readers, writers
from sievewright.specs import QualityGate, SplitConfig

HOUR = 3_600_000


def write(path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([header, *rows])


def postings(n, shift=0):
    for i in range(n):
        job = 1000 + i + shift
        company = "" if i % 19 == 7 else ("9999.0" if i % 23 == 5 else f"{1 + i % 9}.0")
        low, high = ("", "") if i % 3 == 0 else (20 + i % 7, 30 + i % 7)
        yield [
            job,
            company,
            f" Data  Engineer {i % 40} ",
            'Line one, "quoted"\nline two é ﬁne' if i % 5 else "",
            f"City {i % 11}",
            low,
            high,
            "HOURLY",
            "USD",
            1704067200000 + i * HOUR,
            "" if i % 2 else 1704067200000 + i * 2 * HOUR,
            "1.0" if i % 4 == 0 else "",
            "Full-time" if i % 6 else "NA",
        ]


POSTING_HEADER = [
    "job_id",
    "company_id",
    "title",
    "description",
    "location",
    "min_salary",
    "max_salary",
    "pay_period",
    "currency",
    "listed_time",
    "expiry",
    "remote_allowed",
    "formatted_work_type",
]


@pytest.fixture(scope="module")
def dump(tmp_path_factory):
    root = tmp_path_factory.mktemp("dump")
    for version, n, shift in (("Version_2", 150, 100), ("Version_10", 200, 0)):
        folder = root / version
        name = "job_postings.csv" if version == "Version_2" else "postings.csv"
        header = ["id", *POSTING_HEADER[1:], "scraped"] if version == "Version_2" else POSTING_HEADER
        rows = list(postings(n, shift))
        # the first posting comes twice, the later copy with another title
        rows.append([rows[0][0], rows[0][1], "later copy", *rows[0][3:]])
        write(folder / name, header, [[*r, "x"] if version == "Version_2" else r for r in rows])
        write(folder / "companies.csv", ["company_id", "name", "state"], [[c, "" if c == 3 else f"Company {c}", "CA"] for c in range(1, 10)])
        write(folder / "industries.csv", ["industry_id", "industry_name"], [[1, " TECH "], [2, "Health"]])
        write(folder / "job_industries.csv", ["job_id", "industry_id"], [[1000 + i + shift, 1 + i % 2] for i in range(n)] + [[77, 1]])
        if version == "Version_10":
            write(folder / "job_skills.csv", ["job_id", "skill_abr"], [[1000 + i, s] for i in range(n) for s in ("ENG", "IT")])
            write(folder / "benefits.csv", ["job_id", "inferred", "type"], [[1000 + i, 0, " 401(K) "] for i in range(0, n, 2)])
            write(folder / "company_specialities.csv", ["company_id", "speciality"], [[1, "AI"], [1, "ai "], [2, "Ops"]])
            write(folder / "skills.csv", ["skill_abr", "skill_name"], [["ENG", "Engineering"], ["IT", "Info Tech"]])
            write(
                folder / "employee_counts.csv",
                ["company_id", "employee_count", "follower_count", "time_recorded"],
                [[c, c * 10 + k, c, 1700000000 + k] for c in range(1, 10) for k in range(3)],
            )
    return root


def test_discovery(spark, dump):
    paths = readers.list_files(spark, str(dump))
    assert readers.discover_versions(paths) == ["Version_2", "Version_10"]
    chosen, absent = readers.resolve_files(paths, "Version_2", defaults.MANDATORY_FILES, defaults.OPTIONAL_FILES)
    assert chosen["postings"].endswith("job_postings.csv")
    assert "skills" in absent


def test_discovery_errors(spark, tmp_path):
    with pytest.raises(readers.SourceError):
        readers.list_files(spark, str(tmp_path))
    with pytest.raises(readers.SourceError):
        readers.discover_versions(["/x/Other/y.csv"])
    with pytest.raises(readers.SourceError, match="mandatory table postings"):
        readers.resolve_files(["/x/Version_1/companies.csv"], "Version_1", defaults.MANDATORY_FILES, {})


def test_csv_cells(spark, dump, tmp_path):
    df = readers.read_csv(spark, str(dump / "Version_10" / "postings.csv"))
    assert df.count() == 201
    assert df.filter("description like '%\n%'").count() > 0
    assert df.filter("formatted_work_type = 'NA'").count() == 0
    assert set(dict(df.dtypes).values()) == {"string"}
    write(tmp_path / "empty.csv", ["a"], [])
    with pytest.raises(readers.SourceError, match="empty"):
        readers.require_rows(readers.read_csv(spark, str(tmp_path / "empty.csv")), "empty.csv")


def test_ingest_ids_follow_the_file(spark, dump):
    df = readers.with_ingest_id(readers.read_csv(spark, str(dump / "Version_10" / "postings.csv")))
    jobs = [r["job_id"] for r in df.orderBy(readers.INGEST_ID).select("job_id").collect()]
    assert jobs == [str(1000 + i) for i in range(200)] + ["1000"]


@pytest.fixture(scope="module")
def store(spark, dump, tmp_path_factory):
    output = tmp_path_factory.mktemp("out")
    return output, dataset.run_dataset(spark, str(dump), str(output), "run_1")


def test_versions_are_aligned_by_their_own_names(spark, dump):
    versions = readers.load_all(spark, str(dump), defaults.MANDATORY_FILES, defaults.OPTIONAL_FILES, check_empty=False)
    combined, reports = dataset.align_versions(versions)
    assert reports["Version_2"]["postings"].renamed == {"job_id": "id"}
    assert reports["Version_10"]["postings"].renamed == {}
    assert combined["postings"].filter("job_id is null").isEmpty()


def test_dataset_run(spark, store):
    output, df = store
    reports = {"alignment", "validation", "cleaning", "cleaning_failures", "matches", "coverage", "master", "features"}
    assert reports <= {p.name for p in (output / "reports").iterdir()}
    aligned = spark.read.json(str(output / "reports" / "alignment"))
    assert {r[0] for r in aligned.select("dataset_version").distinct().collect()} == {"Version_2", "Version_10"}
    assert {p.name for p in (output / "feature_store").iterdir()} == {"_published", "archive"}
    master = readers.read_table(spark, str(output / "master_dataset"))
    # 150 and 200 postings, minus those without or with an unknown company
    expected = {v: sum(1 for i in range(n) if i % 19 != 7 and i % 23 != 5) for v, n in (("Version_2", 150), ("Version_10", 200))}
    assert {r[0]: r[1] for r in master.groupBy("dataset_version").count().collect()} == expected
    assert master.filter("title = 'later copy'").isEmpty()
    ten = master.filter("dataset_version = 'Version_10'")
    assert ten.filter("company_id = 4").select("company_employee_count").distinct().first()[0] == 42
    assert ten.select("skill_count", "top_skill").distinct().collect() == [(2, "engineering")]
    assert master.filter("dataset_version = 'Version_2' and skill_count <> 0").isEmpty()
    assert master.filter("company_id = 3").select("company_name").distinct().first()[0] == "Unknown Company"
    assert {r[0] for r in master.select("top_industry").distinct().collect()} == {"tech", "health"}
    assert "unmapped__scraped" in master.columns
    archived = spark.read.parquet(str(output / "master_dataset" / "archive" / "run_1"))
    assert archived.count() == master.count()


def test_feature_store(spark, store):
    _, df = store
    assert "job_id" not in df.columns and dict(df.dtypes)["listed_time"] == "timestamp"
    assert dict(df.dtypes)["remote_allowed"] == "boolean"
    row = df.filter("description is not null").select("description").first()
    assert row[0] == 'Line one, "quoted" line two é fine'
    # the flag tells what was known before the gaps were filled
    assert not df.filter("not has_description").isEmpty()
    assert df.filter("skill_list = 'ENGINEERING|INFO_TECH'").count() > 0
    assert df.filter("salary_available <> (min_salary is not null)").isEmpty()


def test_validation_report_was_written(spark, store):
    output, _ = store
    report = spark.read.json(str(output / "reports" / "validation"))
    counts = {(r["dataset_version"], r["table"], r["check"], r["column"]): r["violations"] for r in report.collect()}
    assert counts[("Version_10", "postings", "duplicate_key", "job_id")] == 2
    assert counts[("Version_10", "companies", "null", "name")] == 1
    assert counts[("Version_2", "job_industries", "reference", "job_id")] == 1
    # '1.0' and '1' are the same key only once typed, so text keys count as broken here
    assert validate.summary(report, ("dataset_version",)).first()["tables"] == 13


def test_reports_were_written(spark, store):
    output, df = store
    cleaning = {(r["dataset_version"], r["table"]): r for r in spark.read.json(str(output / "reports" / "cleaning")).collect()}
    postings = cleaning[("Version_10", "postings")]
    assert (postings["rows_before"], postings["duplicates_removed"]) == (201, 1)
    assert postings["rows_before"] - postings["rows_after"] == (
        postings["null_rows_dropped"] + postings["duplicates_removed"] + postings["orphan_rows_removed"]
    )
    matches = {(r["dataset_version"], r["table"]): r["rows_matched"] for r in spark.read.json(str(output / "reports" / "matches")).collect()}
    assert matches[("Version_10", "companies")] == postings["rows_after"]
    assert matches[("Version_2", "job_skills")] == 0
    summary = spark.read.json(str(output / "reports" / "features")).first()
    assert summary["rows_after"] == df.count() and summary["cells_filled"] > 0


def test_a_table_may_be_a_directory(spark, dump, tmp_path):
    for i in range(3):
        write(tmp_path / "Version_1" / "companies.csv" / f"part-{i}.csv", ["company_id", "name"], [[i, f"c{i}"]])
    paths = readers.list_files(spark, str(tmp_path))
    chosen, _ = readers.resolve_files(paths, "Version_1", {"companies": ("companies.csv",)}, {})
    df = readers.with_ingest_id(readers.read_csv(spark, chosen["companies"]))
    assert [r["name"] for r in df.orderBy(readers.INGEST_ID).collect()] == ["c0", "c1", "c2"]


def test_gate_stops_the_run(spark, dump, tmp_path):
    import dataclasses

    plan = dataclasses.replace(dataset.DEFAULT_PLAN, gate=QualityGate(duplicate_keys=True))
    with pytest.raises(validate.QualityGateFailed, match="duplicate key"):
        dataset.run_dataset(spark, str(dump), str(tmp_path / "gated"), "run_1", plan)


def test_lazy_plan_matches_the_run(spark, store):
    output, _ = store
    tables = {p.name: readers.read_table(spark, str(p)) for p in (output / "aligned").iterdir()}
    run = dataset.plan_dataset(tables)
    assert not run.failed
    assert run.master.result.count() == readers.read_table(spark, str(output / "master_dataset")).count()
    assert dataset.validation_by_version(run).count() == 13


def test_salary_run_is_reused(spark, store, tmp_path):
    _, df = store
    config = SplitConfig()
    first = dataset.run_salary(df, str(tmp_path), "s1", split_config=config)
    assert first.rebuilt and first.table.count() == first.split.count() > 0
    assert {r[0] for r in first.split.select("split").distinct().collect()} == {"train", "validation", "test"}
    reports = {"salary_funnel", "salary_description", "salary_coverage", "split_sizes", "split_statistics"}
    assert reports <= {p.name for p in (tmp_path / "reports").iterdir()}
    again = dataset.run_salary(df, str(tmp_path), "s2", split_config=config)
    assert not again.rebuilt and again.split.count() == first.split.count()
    forced = dataset.run_salary(df, str(tmp_path), "s3", split_config=config, force_rebuild=True)
    assert forced.rebuilt
    other = dataset.run_salary(df, str(tmp_path), "s4", split_config=SplitConfig(seed=7))
    assert other.rebuilt
    changed = df.withColumn("title", F.upper("title"))
    assert dataset.run_salary(changed, str(tmp_path), "s5", split_config=SplitConfig(seed=7)).rebuilt


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, None)], "k long, v string")
    writers.write_csv(df, str(tmp_path / "csv"))
    back = readers.read_csv(spark, str(tmp_path / "csv"))
    assert sorted(tuple(r) for r in back.collect()) == [("1", 'a "b", c'), ("2", None)]
    writers.write_report(df, str(tmp_path / "json"))
    lines = [json.loads(line) for p in (tmp_path / "json").glob("part-*") for line in p.read_text().splitlines()]
    assert {"k": 2, "v": None} in lines
    writers.write_parquet(df, str(tmp_path / "pq"), "one")
    writers.write_parquet(df.filter("k = 1"), str(tmp_path / "pq"), "two")
    assert readers.read_table(spark, str(tmp_path / "pq")).count() == 1
    assert spark.read.parquet(str(tmp_path / "pq" / "archive" / "one")).count() == 2


def test_nan_is_null_after_reading(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (1.0,)], "x double").write.parquet(str(tmp_path / "n"))
    assert readers.read_parquet(spark, str(tmp_path / "n")).filter("x is null").count() == 1



# ------------------------------------------------------------ rebuilding what changed


def compared(df):
    """Rows without the ids that follow the files' place."""
    columns = sorted(c for c in df.columns if c != readers.INGEST_ID)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def three_versions(root):
    for version, n, shift in (("Version_1", 40, 0), ("Version_2", 50, 10), ("Version_3", 30, 20)):
        write(root / version / "postings.csv", POSTING_HEADER, postings(n, shift))
        write(root / version / "companies.csv", ["company_id", "name"], [[c, f"Company {c}"] for c in range(1, 10)])
        write(root / version / "industries.csv", ["industry_id", "industry_name"], [[1, "Tech"]])
        write(root / version / "job_industries.csv", ["job_id", "industry_id"], [[1000 + shift + i, 1] for i in range(n)])
    skills = root / "Version_1"
    write(skills / "job_skills.csv", ["job_id", "skill_abr"], [[1000 + i, "ENG"] for i in range(40)])
    write(skills / "skills.csv", ["skill_abr", "skill_name"], [["ENG", "Engineering"]])
    write(skills / "benefits.csv", ["job_id", "inferred", "type"], [[1000, 0, "401(K)"]])
    write(skills / "company_specialities.csv", ["company_id", "speciality"], [[1, "AI"]])


def test_only_changed_versions_are_built(spark, tmp_path, monkeypatch):
    import shutil

    root, output = tmp_path / "dump", str(tmp_path / "out")
    three_versions(root)
    dataset.run_dataset(spark, str(root), output, "r1")
    loaded, plain = [], readers.load_version
    monkeypatch.setattr(readers, "load_version", lambda s, p, v, *rest: loaded.append(v) or plain(s, p, v, *rest))

    def run(name):
        loaded.clear()
        return dataset.run_dataset(spark, str(root), output, name, changed_only=True)

    before = dataset.snapshots.current(spark, f"{output}/master_dataset")
    assert compared(run("r2")) and loaded == []
    assert dataset.snapshots.current(spark, f"{output}/master_dataset") == before

    # one version changes, one goes, one comes
    write(root / "Version_2" / "postings.csv", POSTING_HEADER, postings(45, 300))
    shutil.rmtree(root / "Version_3")
    shutil.copytree(root / "Version_2", root / "Version_4")
    store = run("r3")
    assert loaded == ["Version_2", "Version_4"]
    after = dataset.snapshots.current(spark, f"{output}/master_dataset")
    assert {(p.snapshot, p.folder) for p in after.parts} == {
        ("archive/r1", "dataset_version=Version_1"),
        ("archive/r3", "dataset_version=Version_2"),
        ("archive/r3", "dataset_version=Version_4"),
    }
    full = str(tmp_path / "full")
    assert compared(store) == compared(dataset.run_dataset(spark, str(root), full, "r1"))
    for name in ("master_dataset", "joined", "aligned/postings", "cleaned/companies"):
        assert compared(readers.read_table(spark, f"{output}/{name}")) == compared(readers.read_table(spark, f"{full}/{name}"))
    for name in ("alignment", "validation", "cleaning", "matches", "coverage"):
        found, expected = (spark.read.json(f"{o}/reports/{name}") for o in (output, full))
        assert compared(found) == compared(expected)

    # a version goes and nothing is to be built
    shutil.rmtree(root / "Version_4")
    store = run("r4")
    assert loaded == [] and {r[0] for r in store.select("dataset_version").distinct().collect()} == {"Version_1", "Version_2"}
    # a table that no version had changes them all
    write(root / "Version_2" / "employee_counts.csv", ["company_id", "employee_count", "follower_count", "time_recorded"], [[1, 5, 6, 7]])
    run("r5")
    assert loaded == ["Version_1", "Version_2"]
