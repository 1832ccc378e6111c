"""The two end-to-end plans: dump to feature store, feature store to splits.

Every stage is a lazy plan. A table that feeds several others is written once and
read back, which also cuts the lineage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sievewright import defaults
from sievewright.operators import align, clean, features, fingerprint, master, split, target, validate
from sievewright.plans import incremental
from sievewright.sources import readers, snapshots, writers
from sievewright.specs import (
    BridgeJoin,
    CanonicalSchema,
    CleaningRule,
    DimensionJoin,
    FeatureConfig,
    QualityGate,
    SalaryConfig,
    SnapshotJoin,
    SplitConfig,
    TableRules,
)


@dataclass(frozen=True)
class DatasetPlan:
    """Everything that describes one run; defaults fit the job-postings dump."""

    schemas: Mapping[str, CanonicalSchema]
    validation: Mapping[str, TableRules]
    cleaning: Mapping[str, CleaningRule]
    dimensions: tuple[DimensionJoin, ...]
    snapshots: tuple[SnapshotJoin, ...]
    bridges: tuple[BridgeJoin, ...]
    features: FeatureConfig
    fact: str = "postings"
    fact_key: str = "job_id"
    gate: QualityGate = QualityGate()
    # accepted file names of each table
    mandatory_files: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: defaults.MANDATORY_FILES)
    optional_files: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: defaults.OPTIONAL_FILES)


DEFAULT_PLAN = DatasetPlan(
    defaults.SCHEMAS,
    defaults.VALIDATION_RULES,
    defaults.CLEANING_RULES,
    defaults.DIMENSIONS,
    defaults.SNAPSHOTS,
    defaults.BRIDGES,
    defaults.FEATURES,
)


OWN = (readers.VERSION, readers.INGEST_ID)
SCOPE, ORDER = (readers.VERSION,), (readers.INGEST_ID,)


@dataclass(frozen=True)
class DatasetRun:
    validation: DataFrame
    cleaned: dict[str, clean.CleanedTable]
    failed: dict[str, str]
    master: master.Joined
    features: features.FeatureBuild


def align_versions(
    versions: Mapping[str, Mapping[str, DataFrame]], plan: DatasetPlan = DEFAULT_PLAN
) -> tuple[dict[str, DataFrame], dict[str, dict[str, align.Alignment]]]:
    """Align each version by its own column names, then unite the versions.

    From here on every table is one DataFrame with a version column, so each rule
    and join is planned once however many versions there are.
    """
    aligned: dict[str, dict[str, DataFrame]] = {}
    reports: dict[str, dict[str, align.Alignment]] = {}
    for version, tables in versions.items():
        aligned[version], reports[version] = align.align_all(tables, plan.schemas, passthrough=OWN)
    return readers.combine_versions(aligned), reports


def plan_dataset(aligned: Mapping[str, DataFrame], plan: DatasetPlan = DEFAULT_PLAN) -> DatasetRun:
    """Lazy plans of all stages over aligned tables; only the heavy keys of the joins are counted at once.

    The tables carry ``dataset_version`` and ``_ingest_id``. Keys, joins and
    checks hold within a version.
    """
    report = validate.validate(aligned, plan.validation, plan.schemas, SCOPE)
    cleaned, failed = clean.clean_all(aligned, plan.cleaning, plan.schemas, ORDER, SCOPE)
    results = {name: c.result for name, c in cleaned.items()}
    joined = _join(results, plan)
    return DatasetRun(report, cleaned, failed, joined, features.build_features(joined.result, plan.features))


def _join(tables: Mapping[str, DataFrame], plan: DatasetPlan) -> master.Joined:
    fact = tables[plan.fact].drop(readers.INGEST_ID)
    return master.build_master(
        fact, tables, plan.dimensions, plan.snapshots, plan.bridges, order_by=ORDER, scope=SCOPE
    )


def run_dataset(
    spark: SparkSession,
    root: str,
    output: str,
    dataset_id: str,
    plan: DatasetPlan = DEFAULT_PLAN,
    changed_only: bool = False,
) -> DataFrame:
    """Ingest a dump and write its reports, master table and feature store.

    Reports: alignment, validation, cleaning (and the tables it had to leave out),
    matches, coverage, the build as a whole, and features.

    Aligned tables, cleaned tables and the master are written and read back, so
    each is computed once although several outputs need it. The written copy also
    fixes the ingest ids: a lost task cannot renumber rows.

    With ``changed_only`` only versions whose files or plan differ from the last
    run are read and built. Versions that are gone are dropped, and all other
    partitions of tables and reports stay as they are. Rules, joins and reports
    hold within a version, so the result is that of a full run; a column that
    only dropped rows had stays, as nulls. The feature store fills gaps with
    medians and modes of all versions, so it is built from the whole master
    table. A table that no version had before makes all versions changed.
    """
    paths = readers.list_files(spark, root)
    names = readers.discover_versions(paths)
    chosen = {v: readers.resolve_files(paths, v, plan.mandatory_files, plan.optional_files)[0] for v in names}
    known = sorted({table for tables in chosen.values() for table in tables})
    files = fingerprint.content_fingerprint(readers.source_files(spark, root), SCOPE, hash_of((plan, known)))
    found = incremental.find_changes(files, f"{output}/master_dataset", readers.VERSION)
    if changed_only and not found.to_build and not found.to_drop:
        return snapshots.read(spark, f"{output}/feature_store")
    if changed_only:
        run = _VersionRun(spark, output, plan, found.to_build, sorted({*found.to_build, *found.to_drop}))
    else:
        run = _VersionRun(spark, output, plan, names, None)
    state = [list(row) for row in found.state]
    if run.build:
        joined = run.joined(paths, known)
        run.store(joined.result, "master_dataset", dataset_id, state)
    else:
        run.drop(known, state)
    whole = snapshots.read(spark, f"{output}/master_dataset")
    if run.build:
        writers.write_report(master.master_summary(whole, joined), f"{output}/reports/master")

    made = features.build_features(whole, plan.features)
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(features.null_total(made.result)), F.lit(0)).alias("nulls")]
    written = writers.write_parquet(made.result.observe(seen, *counts), f"{output}/feature_store", dataset_id, partition_by=SCOPE)
    features.validate_features(written, plan.features)
    after = spark.createDataFrame([(seen.get["rows"], seen.get["nulls"])], "rows bigint, nulls bigint")
    writers.write_report(features.feature_summary(replace(made, result=written), after), f"{output}/reports/features")
    return written


@dataclass(frozen=True)
class _VersionRun:
    """The stages up to the joined table, over the versions ``build``; ``replaced`` (None: all) make room for them."""

    spark: SparkSession
    output: str
    plan: DatasetPlan
    build: list[str]
    replaced: list[str] | None

    def store(self, df: DataFrame, name: str, dataset_id: str | None = None, state: object = None) -> DataFrame:
        """Publish the rows of the versions built, and return them alone."""
        root = f"{self.output}/{name}"
        if self.replaced is None:
            return snapshots.write(df, root, SCOPE, dataset_id, state)
        return snapshots.replace(df, root, readers.VERSION, self.replaced, dataset_id, state)

    def store_counted(self, df: DataFrame, name: str, counts: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
        """:meth:`store`, and ``(dataset_version, *counts)``: sums over each version's rows, taken by the writing tasks.

        The sums are observed behind the last shuffle, in the stage that ends the
        job, where a task that is repeated counts once.
        """
        seen, names = Observation(), list(counts)
        sums = [
            F.coalesce(F.sum(F.when(F.col(readers.VERSION) == v, counts[c])), F.lit(0)).cast("bigint").alias(f"{i}_{j}")
            for i, v in enumerate(self.build)
            for j, c in enumerate(names)
        ]
        stored = self.store(df.observe(seen, *sums), name)
        found = [(v, *(seen.get[f"{i}_{j}"] for j in range(len(names)))) for i, v in enumerate(self.build)]
        schema = ", ".join([f"{readers.VERSION} string", *(f"`{c}` bigint" for c in names)])
        return stored, self.spark.createDataFrame(found, schema)

    def report(self, found: list[DataFrame], name: str) -> str:
        path = f"{self.output}/reports/{name}"
        writers.write_report(reduce(DataFrame.unionByName, found), path, SCOPE, self.replaced)
        return path

    def joined(self, paths: list[str], known: list[str]) -> master.Joined:
        """Align, validate, clean and join."""
        spark, plan = self.spark, self.plan
        versions = {
            v: readers.load_version(spark, paths, v, plan.mandatory_files, plan.optional_files) for v in self.build
        }
        combined, alignments = align_versions(versions, plan)
        found = [
            align.alignment_report(versions[version][name], name, alignment).withColumn(readers.VERSION, F.lit(version))
            for version, tables in alignments.items()
            for name, alignment in tables.items()
        ]
        self.report(found, "alignment")
        aligned = {name: self.store(df, f"aligned/{name}") for name, df in combined.items()}
        for name in sorted(set(known) - set(aligned)):
            # only other versions have this table: its joins give these versions no match rather than no columns
            aligned[name] = spark.createDataFrame([], snapshots.current(spark, f"{self.output}/aligned/{name}").schema)
        report = validate.validate(aligned, plan.validation, plan.schemas, SCOPE)
        path = self.report([report], "validation")
        written = spark.read.schema(report.schema).json(path).filter(F.col(readers.VERSION).isin(self.build))
        validate.enforce(validate.summary(written, SCOPE), plan.gate)

        tables: dict[str, DataFrame] = {}
        reports: list[DataFrame] = []
        failed: list[tuple[str, str]] = []
        for name in clean.parents_first(list(aligned), plan.cleaning):
            rule, schema = plan.cleaning.get(name, CleaningRule()), plan.schemas.get(name)
            try:
                cleaned = clean.clean_table(aligned[name], name, rule, tables, schema, ORDER, SCOPE)
            except (AnalysisException, ValueError) as error:
                # a table that cannot be cleaned is left out; without the fact there is nothing to build
                if name == plan.fact:
                    raise
                failed.append((name, str(error)))
                continue
            # the rows are counted as they are written
            tables[name], after = self.store_counted(cleaned.result, f"cleaned/{name}", {"rows_after": F.lit(1)})
            after = after.filter("rows_after > 0")
            reports.append(clean.cleaning_report(replace(cleaned, result=tables[name]), after))
        self.report(reports, "cleaning")
        failures = spark.createDataFrame(failed, "table string, error string")
        writers.write_report(failures, f"{self.output}/reports/cleaning_failures")

        # the match flags are stored with a working copy, so the joins run once
        joined = _join(tables, plan)
        flagged, counts = self.store_counted(
            joined.df,
            "joined",
            {
                "rows_total": F.lit(1),
                **{table: F.col(flag).isNotNull().cast("int") for table, flag in joined.matches.items()},
                **{f"coverage.{c}": F.col(f"`{c}`").isNotNull().cast("int") for c in joined.created},
            },
        )
        counts = counts.filter("rows_total > 0")
        joined = replace(joined, df=flagged)
        matched = counts.select(*SCOPE, "rows_total", *[f"`{table}`" for table in joined.matches])
        self.report([master.match_report(matched, joined, SCOPE)], "matches")
        shares = [(F.col(f"`coverage.{c}`") * F.lit(100.0) / F.col("rows_total")).alias(c) for c in joined.created]
        self.report([counts.select(*SCOPE, *shares).unpivot(list(SCOPE), list(joined.created), "column", "coverage")], "coverage")
        master.enforce_integrity(master.integrity_counts(tables[plan.fact], flagged, plan.fact_key, SCOPE))
        return joined

    def drop(self, known: list[str], state: object) -> None:
        """Take the versions that are gone out of every table and report; nothing is built."""
        for name in [f"{stage}/{n}" for n in known for stage in ("aligned", "cleaned")] + ["joined"]:
            if snapshots.current(self.spark, f"{self.output}/{name}"):
                snapshots.replace(None, f"{self.output}/{name}", readers.VERSION, self.replaced)
        for name in ("alignment", "validation", "cleaning", "matches", "coverage"):
            writers.drop_report_parts(self.spark, f"{self.output}/reports/{name}", readers.VERSION, self.replaced)
        snapshots.replace(None, f"{self.output}/master_dataset", readers.VERSION, self.replaced, state=state)


@dataclass(frozen=True)
class SalaryRun:
    table: DataFrame
    split: DataFrame
    rebuilt: bool


def run_salary(
    feature_store: DataFrame,
    output: str,
    dataset_id: str,
    config: SalaryConfig = defaults.SALARY,
    split_config: SplitConfig = SplitConfig(),
    force_rebuild: bool = False,
) -> SalaryRun:
    """Build and split the salary table, unless neither input nor config changed.

    Beside the two tables it writes reports: funnel, description and coverage of
    the target, sizes and statistics of the parts.

    The decision compares content fingerprints with those stored last time; they
    are stored only after both outputs were written.
    """
    spark = feature_store.sparkSession
    by = [readers.VERSION]
    config_hash = f"{hash_of(config)}:{hash_of(split_config)}"
    current = fingerprint.content_fingerprint(feature_store, by, config_hash)
    state = f"{output}/state"
    if not force_rebuild and _is_current(spark, current, state, by):
        return SalaryRun(
            snapshots.read(spark, f"{output}/salary"), snapshots.read(spark, f"{output}/split"), False
        )
    built = target.build_salary_table(feature_store, config)
    table = writers.write_parquet(built.result, f"{output}/salary", dataset_id)
    writers.write_report(target.funnel(built.staged), f"{output}/reports/salary_funnel")
    writers.write_report(target.describe(table, target.ANNUAL), f"{output}/reports/salary_description")
    writers.write_report(target.coverage(built.staged), f"{output}/reports/salary_coverage")
    target.enforce_integrity(target.integrity(table, config))
    split.validate_input(table, split_config)
    parts = writers.write_parquet(
        split.group_split(table, split_config), f"{output}/split", dataset_id, partition_by=[split.SPLIT]
    )
    split.check_split(table, parts, split_config)
    writers.write_report(split.part_sizes(parts, split_config), f"{output}/reports/split_sizes")
    writers.write_report(split.part_statistics(parts, target.ANNUAL), f"{output}/reports/split_statistics")
    current.write.mode("overwrite").parquet(state)
    return SalaryRun(table, parts, True)


def _is_current(spark: SparkSession, current: DataFrame, state: str, by: list[str]) -> bool:
    try:
        stored = spark.read.parquet(state)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False  # first run: nothing stored yet
    return fingerprint.is_unchanged(current, stored, by)


def hash_of(config: object) -> str:
    """Short stable hash of a frozen spec."""
    return hashlib.sha256(repr(config).encode()).hexdigest()[:16]


def validation_by_version(run: DatasetRun) -> DataFrame:
    return validate.table_verdicts(run.validation, (readers.VERSION,)).orderBy(F.col(readers.VERSION), "table")
