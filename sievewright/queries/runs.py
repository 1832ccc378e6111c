"""Steps of a run as queries: aligning all tables, the gate, fingerprints of schemas, writing and reading back."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.operators import align, features, sketches, split, target, validate
from sievewright.queries import modelling
from sievewright.queries.profiles import FOUR_VERSIONS, four_versions
from sievewright.queries.quality import _CORPUS_FINDINGS, CUSTOMER_SCHEMA, ORDERS_SCHEMA, _corpus_report
from sievewright.queries.registry import query, table
from sievewright.plans import incremental
from sievewright.sources import readers, snapshots, writers
from sievewright.specs import FeatureConfig, QualityGate


@query(
    "align_all_tables",
    """
    SELECT 'customer' AS "table", count(c_custkey) AS keys, round(sum(c_acctbal), 2) AS total, 3 AS renamed, 2 AS missing, 2 AS unmapped FROM customer
    UNION ALL SELECT 'orders', count(o_orderkey), round(sum(o_totalprice), 2), 2, 1, 3 FROM orders
    """,
)
def align_all_tables(spark: SparkSession, folder: str) -> DataFrame:
    tables = {name: table(spark, folder, name) for name in ("customer", "orders")}
    aligned, reports = align.align_all(tables, {"customer": CUSTOMER_SCHEMA, "orders": ORDERS_SCHEMA})
    measures = {"customer": ("customer_id", "balance"), "orders": ("o_orderkey", "total")}
    parts = []
    for name, (key, amount) in measures.items():
        sums = aligned[name].agg(F.count(key).alias("keys"), F.round(F.sum(amount), 2).alias("total"))
        found = {k: F.lit(len(getattr(reports[name], k))).alias(k) for k in ("renamed", "missing", "unmapped")}
        parts.append(sums.select(F.lit(name).alias("table"), "keys", "total", *found.values()))
    return parts[0].unionByName(parts[1])


@query(
    "validate_gate",
    "WITH"
    + _CORPUS_FINDINGS
    + """,
    kinds(finding, "check", gated) AS (VALUES ('structural_issues', 'structure', false), ('null_violations', 'null', true),
      ('duplicate_key_rows', 'duplicate_key', false), ('invalid_values', 'value', true), ('dtype_issues', 'dtype', false),
      ('broken_references', 'reference', true)),
    counted AS (SELECT finding, gated, coalesce(sum(violations), 0)::BIGINT AS violations
      FROM kinds LEFT JOIN corpus USING ("check") GROUP BY ALL)
    SELECT finding, violations, gated, gated AND violations > 0 AS stops FROM counted
    """,
)
def validate_gate(spark: SparkSession, folder: str) -> DataFrame:
    gate = QualityGate(nulls=True, invalid_values=True, broken_references=True)
    return validate.gate_findings(validate.summary(_corpus_report(spark, folder)), gate)


@query(
    "schema_fingerprints",
    """
    SELECT 'customer' AS "table", count(*) AS rows,
           sha256('c_acctbal:double|c_custkey:bigint|c_mktsegment:string|c_name:string|c_nationkey:int') AS fingerprint FROM customer
    UNION ALL SELECT 'documents', count(*), sha256('doc_id:bigint|lang:string|n_chars:bigint|source:string|text:string') FROM documents
    """,
)
def schema_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    parts = []
    for name in ("customer", "documents"):
        df = table(spark, folder, name)
        mark = F.lit(features.schema_fingerprint(df)).alias("fingerprint")
        parts.append(df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows", mark))
    return parts[0].unionByName(parts[1])


def _scratch(spark: SparkSession) -> str:
    """A new folder where all executors can write; a local session without one gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="sievewright-")
    return f"{folder.rstrip('/')}/written/{uuid.uuid4().hex}"


@query(
    "written_and_read_back",
    """
    SELECT o_orderstatus, count(*) AS rows, count(o_orderkey) AS keys, round(sum(o_totalprice), 2) AS total,
           count(*) AS archived FROM orders GROUP BY o_orderstatus
    """,
)
def written_and_read_back(spark: SparkSession, folder: str) -> DataFrame:
    root = _scratch(spark)
    writers.write_parquet(table(spark, folder, "orders"), root, "run_1", partition_by=["o_orderstatus"])
    latest = readers.read_table(spark, root).groupBy("o_orderstatus").agg(
        F.count("*").alias("rows"), F.count("o_orderkey").alias("keys"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
    archived = readers.read_parquet(spark, f"{root}/archive/run_1").groupBy("o_orderstatus").agg(F.count("*").alias("archived"))
    return latest.join(archived, "o_orderstatus")


_VERSION_OF_ORDERS = "CASE WHEN year(o_orderdate) < 1997 THEN 'Version_1' WHEN year(o_orderdate) < 1999 THEN 'Version_2' ELSE 'Version_3' END"


def _totals_by_segment(orders: DataFrame, customer: DataFrame) -> DataFrame:
    joined = orders.join(customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    return joined.groupBy("dataset_version", "c_mktsegment").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "rebuilt_versions",
    f"""
    WITH first_run AS (SELECT *, {_VERSION_OF_ORDERS} AS dataset_version FROM orders),
    dump AS (
      SELECT o_custkey, o_totalprice, dataset_version, 'unchanged' AS status FROM first_run WHERE dataset_version = 'Version_1'
      UNION ALL SELECT o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END, 'Version_2', 'changed'
        FROM first_run WHERE dataset_version = 'Version_2'
      UNION ALL SELECT o_custkey, o_totalprice, 'Version_4', 'new' FROM first_run WHERE o_orderstatus = 'F')
    SELECT dataset_version, status, c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS total
    FROM dump JOIN customer ON o_custkey = c_custkey GROUP BY ALL
    """,
)
def rebuilt_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of three versions, brought up to date after one changed, one went and one came."""
    root, customer = _scratch(spark), table(spark, folder, "customer")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.expr(_VERSION_OF_ORDERS).alias("dataset_version"))
    snapshots.write(orders, f"{root}/dump", ["dataset_version"])

    def refresh() -> tuple[DataFrame, dict[str, str]]:
        return incremental.rebuild_from(f"{root}/dump", spark, f"{root}/totals", "dataset_version", lambda changed: _totals_by_segment(changed, customer))

    refresh()
    raised = F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    second = orders.filter("dataset_version = 'Version_2'").withColumn("o_totalprice", raised)
    fourth = orders.filter("o_orderstatus = 'F'").withColumn("dataset_version", F.lit("Version_4"))
    snapshots.replace(second.unionByName(fourth), f"{root}/dump", "dataset_version", ["Version_3"])
    totals, status = refresh()
    told = F.create_map(*[F.lit(x) for part, what in status.items() for x in (part.split("=")[1], what)])
    return totals.withColumn("status", told[F.col("dataset_version")])


@query(
    "distinct_values_by_stored_sketches",
    f"""
    WITH {FOUR_VERSIONS},
    shared AS (SELECT o_custkey FROM pairs GROUP BY 1 HAVING count(*) = 4)
    SELECT dataset_version AS scope, count(*) AS "distinct", true AS estimate_within_3_percent FROM pairs GROUP BY 1
    UNION ALL SELECT 'any', count(DISTINCT o_custkey), true FROM pairs
    UNION ALL SELECT 'all', count(*), true FROM shared
    """,
)
def distinct_values_by_stored_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Customers per version, of all versions and common to them: exact, and estimated from sketches written per version."""
    four, root = four_versions(spark, folder), _scratch(spark)
    made = sketches.distinct_sketches(four, ["o_custkey"], ["dataset_version"])
    stored = snapshots.write(made, root, ["dataset_version"])
    one = sketches.distinct_estimates(stored, ["dataset_version"]).withColumnRenamed("dataset_version", "scope")
    union = sketches.distinct_estimates(stored, ["column"]).select(F.lit("any").alias("scope"), "estimate")
    common = sketches.common_estimates(stored, ["column"]).select(F.lit("all").alias("scope"), "estimate")
    keys = four.select("o_custkey", "dataset_version").distinct()
    held = keys.groupBy("o_custkey").agg(F.count("*").alias("n"))
    exact = keys.groupBy(F.col("dataset_version").alias("scope")).agg(F.count("*").alias("distinct"))
    totals = held.agg(F.count("*").alias("any"), F.count_if(F.col("n") == 4).alias("all")).unpivot([], ["any", "all"], "scope", "distinct")
    # an intersection is estimated within a share of the union it is cut from
    whole = held.agg(F.count("*")).scalar()
    both = exact.unionByName(totals).join(one.union(union).union(common), "scope").withColumn("whole", whole)
    base = F.when(F.col("scope") == "all", F.col("whole")).otherwise(F.col("distinct"))
    return both.select("scope", "distinct", (F.abs(F.col("estimate") - F.col("distinct")) <= 0.03 * base).alias("estimate_within_3_percent"))


@query(
    "quantiles_of_merged_sketches",
    """
    SELECT q AS quantile, (SELECT count(*) FROM lineitem) AS "values", true AS rank_within_1_percent
    FROM (VALUES ('p10'), ('p50'), ('p90')) t(q)
    """,
)
def quantiles_of_merged_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Quantiles of all line prices from a sketch written per year, held against their exact ranks."""
    lines, root, probs = table(spark, folder, "lineitem"), _scratch(spark), {"p10": 0.1, "p50": 0.5, "p90": 0.9}
    made = sketches.value_sketches(lines.withColumn("year", F.year("l_shipdate")), "l_extendedprice", ["year"])
    merged = sketches.merged_quantiles(snapshots.write(made, root, ["year"]), [], probs).select(F.struct("values", *probs)).scalar()
    placed = lines.select("l_extendedprice").withColumn("_sw_q", merged)
    below = [F.count_if(F.col("l_extendedprice") <= F.col(f"_sw_q.{name}")).alias(name) for name in probs]
    ranks = placed.agg(F.max("_sw_q.values").alias("values"), *below)
    entries = [
        F.struct(F.lit(name).alias("quantile"), "values", (F.abs(F.col(name) / F.col("values") - p) <= 0.01).alias("rank_within_1_percent"))
        for name, p in probs.items()
    ]
    return ranks.select(F.inline(F.array(*entries)))


@query(
    "features_column_kinds",
    """
    SELECT 'o_orderkey' AS "column", 'identifier' AS kind, count(o_orderkey) AS present FROM orders
    UNION ALL SELECT 'o_custkey', 'number', count(o_custkey) FROM orders
    UNION ALL SELECT 'o_orderstatus', 'category', count(o_orderstatus) FROM orders
    UNION ALL SELECT 'o_totalprice', 'number', count(o_totalprice) FROM orders
    UNION ALL SELECT 'o_orderdate', 'datetime', count(o_orderdate) FROM orders
    UNION ALL SELECT 'o_orderpriority', 'other', count(o_orderpriority) FROM orders
    """,
)
def features_column_kinds(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    config = FeatureConfig(identifiers=("o_orderkey",), datetimes=("o_orderdate",), categories=("o_orderstatus",))
    kinds = features.column_kinds(orders, config)
    wide = orders.agg(*[F.count(c).alias(c) for c in kinds])
    told = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return wide.unpivot([], list(kinds), "column", "present").select("column", told[F.col("column")].alias("kind"), "present")


@query(
    "dump_loaded_again",
    """
    WITH dump AS (
      SELECT 'customer' AS "table", 'Version_1' AS dataset_version, c_custkey AS key, c_acctbal AS amount FROM customer
      UNION ALL SELECT 'customer', 'Version_2', c_custkey, c_acctbal FROM customer WHERE c_custkey % 2 = 0
      UNION ALL SELECT 'orders', 'Version_1', o_orderkey, o_totalprice FROM orders
      UNION ALL SELECT 'orders', 'Version_2', CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END, o_totalprice FROM orders)
    SELECT "table", dataset_version, count(*) AS rows, count(*) AS ids, count(key) AS keys, round(sum(amount), 2) AS total,
           max(CASE "table" WHEN 'customer' THEN (SELECT count(*) FROM customer) ELSE (SELECT count(*) FROM orders) END) AS source_rows
    FROM dump GROUP BY ALL
    """,
)
def dump_loaded_again(spark: SparkSession, folder: str) -> DataFrame:
    """A dump of two versions written as CSV, found, read and united: other file names, gaps, an absent table."""
    root = _scratch(spark)
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    gap = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey"))
    writers.write_csv(customer, f"{root}/Version_1/customer.csv")
    writers.write_csv(orders, f"{root}/Version_1/orders.csv")
    writers.write_csv(customer.filter("c_custkey % 2 = 0"), f"{root}/Version_2/clients.csv")
    writers.write_csv(orders.withColumn("o_orderkey", gap), f"{root}/Version_2/orders.csv")
    accepted = {"customer": ("customer.csv", "clients.csv"), "orders": ("orders.csv",)}
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # that the optional table is absent
        versions = readers.load_all(spark, root, accepted, {"notes": ("notes.csv",)})
    columns = {"customer": ("c_custkey", "c_acctbal"), "orders": ("o_orderkey", "o_totalprice")}
    parts = []
    for name, df in readers.combine_versions(versions).items():
        key, amount = columns[name]
        sums = df.groupBy(readers.VERSION).agg(
            F.count("*").alias("rows"),
            F.count_distinct(readers.INGEST_ID).alias("ids"),
            F.count(key).alias("keys"),
            F.round(F.sum(F.col(amount).cast("double")), 2).alias("total"),
        )
        before = table(spark, folder, name).agg(F.count("*")).scalar()
        parts.append(sums.withColumns({"table": F.lit(name), "source_rows": before}))
    return parts[0].unionByName(parts[1])


@query(
    "report_written_and_read_back",
    """
    SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS segment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance,
           round(100.0 * count(*) / (SELECT count(*) FROM customer), 6) AS share
    FROM customer GROUP BY 1
    """,
)
def report_written_and_read_back(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{_scratch(spark)}/report"
    segment = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("segment")
    report = table(spark, folder, "customer").groupBy(segment).agg(F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    writers.write_report(report, path)
    whole = table(spark, folder, "customer").agg(F.count("*")).scalar()
    share = F.round(F.col("customers") * F.lit(100.0) / whole, 6)
    return spark.read.schema(report.schema).json(path).withColumn("share", share)


@query(
    "verdicts_of_checks",
    """
    WITH n AS (SELECT count(*) AS rows FROM orders)
    SELECT * FROM n, (VALUES ('columns of the target', 'passed'), ('columns of the target, one absent', 'failed'),
      ('features', 'passed'), ('features, one flag absent', 'failed'), ('features, no rows', 'failed'),
      ('leakage', 'passed'), ('leakage, a salary as predictor', 'failed'),
      ('schemas of the parts', 'passed'), ('schemas of the parts, one retyped', 'failed')) t("check", verdict)
    """,
)
def verdicts_of_checks(spark: SparkSession, folder: str) -> DataFrame:
    """What the checks that stop a run say about orders, whole and spoilt."""
    posted, orders = modelling.postings(spark, folder), table(spark, folder, "orders")
    flagged = orders.withColumn("has_total", F.col("o_totalprice").isNotNull())
    config = FeatureConfig(presence_flags={"has_total": ("o_totalprice",)})
    labelled = split.group_split(orders.withColumn("log_price", F.log("o_totalprice")), modelling.BY_CUSTOMER)
    parts = {name: labelled.filter(F.col(split.SPLIT) == name) for name in ("train", "test")}
    retyped = {**parts, "test": parts["test"].withColumn("o_custkey", F.col("o_custkey").cast("string"))}
    checks = {
        "columns of the target": lambda: target.check_columns(posted, modelling.CONFIG),
        "columns of the target, one absent": lambda: target.check_columns(posted.drop("max_salary"), modelling.CONFIG),
        "features": lambda: features.validate_features(flagged, config),
        "features, one flag absent": lambda: features.validate_features(orders, config),
        "features, no rows": lambda: features.validate_features(flagged.filter("o_orderkey is null"), config),
        "leakage": lambda: target.check_leakage(["priority", "followers"], modelling.CONFIG),
        "leakage, a salary as predictor": lambda: target.check_leakage(["priority", "max_salary"], modelling.CONFIG),
        "schemas of the parts": lambda: split.same_schema(parts),
        "schemas of the parts, one retyped": lambda: split.same_schema(retyped),
    }
    found = []
    for name, check in checks.items():
        try:
            check()
        except (features.FeatureStoreInvalid, target.SalaryTableInvalid, split.SplitInvalid):
            found.append((name, "failed"))
        else:
            found.append((name, "passed"))
    verdicts = spark.createDataFrame(found, "check string, verdict string")
    return verdicts.withColumn("rows", orders.agg(F.count("*")).scalar())
