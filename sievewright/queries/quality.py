"""Alignment, validation and cleaning on the driver tables.

These tables are clean, so defects are added by formula, the same way in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions import columns as X
from sievewright.operators import align, clean, dedupe, validate
from sievewright.queries.registry import query, rounded, table, without_keys
from sievewright.specs import (
    CanonicalColumn,
    CanonicalSchema,
    CleaningRule,
    DuplicatePolicy,
    InvalidValuePolicy,
    NullPolicy,
    Reference,
    TableRules,
    ValueRule,
)

C = CanonicalColumn

# ------------------------------------------------------------------- alignment

CUSTOMER_SCHEMA = CanonicalSchema(
    (
        C("customer_id", "bigint", ("id", "c_custkey"), required=True),
        C("name", "string", ("C_NAME",)),
        C("balance", "double", ("c_acctbal",)),
        C("phone", "string"),
        C("rating", "bigint"),
    )
)
ORDERS_SCHEMA = CanonicalSchema(
    (
        C("o_orderkey", "bigint", required=True),
        C("customer_id", "bigint", ("o_custkey",)),
        C("total", "double", ("O_TOTALPRICE",)),
        C("clerk", "string"),
    )
)


@query(
    "align_columns",
    """
    SELECT c_custkey AS customer_id, c_name AS name, c_acctbal AS balance,
           coalesce(CAST(NULL AS VARCHAR), '?') AS phone, coalesce(CAST(NULL AS BIGINT), -1) AS rating,
           c_nationkey AS unmapped__c_nationkey, c_mktsegment AS unmapped__c_mktsegment
    FROM customer
    """,
)
def align_columns(spark: SparkSession, folder: str) -> DataFrame:
    aligned, _ = align.align(table(spark, folder, "customer"), CUSTOMER_SCHEMA)
    return aligned.fillna({"phone": "?", "rating": -1})


@query(
    "align_dropping_unmapped",
    "SELECT o_orderkey, o_custkey AS customer_id, o_totalprice AS total, '-' AS clerk FROM orders",
)
def align_dropping_unmapped(spark: SparkSession, folder: str) -> DataFrame:
    aligned, _ = align.align(table(spark, folder, "orders"), ORDERS_SCHEMA, keep_unmapped=False)
    return aligned.fillna("-")


def _alignment_reports(spark: SparkSession, folder: str) -> DataFrame:
    parts = []
    for name, schema in (("customer", CUSTOMER_SCHEMA), ("orders", ORDERS_SCHEMA), ("region", None)):
        df = table(spark, folder, name)
        _, report = align.align(df, schema)
        parts.append(align.alignment_report(df, name, report))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_ALIGNMENT_SQL = """
    WITH findings("table", finding, "column", source) AS (VALUES
      ('customer', 'renamed', 'customer_id', 'c_custkey'), ('customer', 'renamed', 'name', 'c_name'),
      ('customer', 'renamed', 'balance', 'c_acctbal'), ('customer', 'missing', 'phone', '-'),
      ('customer', 'missing', 'rating', '-'), ('customer', 'unmapped', 'c_nationkey', 'c_nationkey'),
      ('customer', 'unmapped', 'c_mktsegment', 'c_mktsegment'),
      ('orders', 'renamed', 'customer_id', 'o_custkey'), ('orders', 'renamed', 'total', 'o_totalprice'),
      ('orders', 'missing', 'clerk', '-'), ('orders', 'unmapped', 'o_orderstatus', 'o_orderstatus'),
      ('orders', 'unmapped', 'o_orderdate', 'o_orderdate'),
      ('orders', 'unmapped', 'o_orderpriority', 'o_orderpriority'),
      ('region', 'unmapped', 'r_regionkey', 'r_regionkey'), ('region', 'unmapped', 'r_name', 'r_name'),
      ('region', 'no_schema', '-', '-')),
    sizes("table", rows) AS (
      SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
      UNION ALL SELECT 'region', count(*) FROM region)
"""


@query(
    "align_report",
    _ALIGNMENT_SQL + """SELECT "table", rows, finding, "column", source FROM findings JOIN sizes USING ("table")""",
)
def align_report(spark: SparkSession, folder: str) -> DataFrame:
    return _alignment_reports(spark, folder).fillna("-", subset=["column", "source"])


@query(
    "align_summary",
    _ALIGNMENT_SQL
    + """
    SELECT count(DISTINCT "table") AS tables,
           count(*) FILTER (WHERE finding = 'renamed') AS renamed,
           count(*) FILTER (WHERE finding = 'missing') AS missing,
           count(*) FILTER (WHERE finding = 'unmapped') AS unmapped
    FROM findings JOIN sizes USING ("table")
    """,
)
def align_summary(spark: SparkSession, folder: str) -> DataFrame:
    return align.alignment_summary(_alignment_reports(spark, folder))


@query(
    "align_empty_required_columns",
    """
    SELECT 'tag' AS "column" FROM (
      SELECT count(CASE WHEN e.user_id < 0 THEN e.event_type END) AS present, count(*) AS n FROM events e)
    WHERE present = 0 AND n > 0
    """,
)
def align_empty_required_columns(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id", F.when(F.col("user_id") < 0, F.col("event_type")).alias("tag")
    )
    schema = CanonicalSchema((C("event_id", "bigint", required=True), C("tag", "string", required=True)))
    return align.empty_required(events, schema)


# ------------------------------------------------------------------ validation


def dirty_customer(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with null names, unparsable balances and unknown segments."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.when(key % 7 == 0, None).otherwise(F.col("c_name")).alias("c_name"),
        F.when(key % 11 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        F.when(key % 13 == 0, None).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        "c_nationkey",
    )


_DIRTY_CUSTOMER = """
    dirty AS (
      SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS c_name,
             CASE WHEN c_custkey % 11 = 0 THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR) END AS c_acctbal,
             CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_nationkey
      FROM customer)
"""

CUSTOMER_TYPES = CanonicalSchema(
    (C("c_custkey", "bigint"), C("c_name", "string"), C("c_acctbal", "double"), C("c_phone", "string"))
)
CUSTOMER_RULES = TableRules(
    unique_key=("c_nationkey", "c_mktsegment"),
    not_null=("c_custkey", "c_name", "c_mktsegment"),
    values={
        "c_acctbal": ValueRule(minimum=0, maximum=9000),
        "c_mktsegment": ValueRule(allowed=("BUILDING", "MACHINERY", "AUTOMOBILE", "FURNITURE")),
        "c_name": ValueRule(pattern=r"Customer#\d+[0-6]$"),
    },
    references=(Reference("c_nationkey", "nation", "n_nationkey"),),
)

_CUSTOMER_FINDINGS = (
    _DIRTY_CUSTOMER
    + """,
    findings AS (
      SELECT 'rows' AS "check", '-' AS "column", count(*) AS violations FROM dirty
      UNION ALL SELECT 'structure', 'dtypes.c_phone', 1
      UNION ALL SELECT 'null', 'c_name', count(*) FROM dirty WHERE c_name IS NULL
      UNION ALL SELECT 'null', 'c_mktsegment', count(*) FROM dirty WHERE c_mktsegment IS NULL
      UNION ALL SELECT 'value', 'c_acctbal', count(*) FROM dirty
        WHERE try_cast(c_acctbal AS DOUBLE) < 0 OR try_cast(c_acctbal AS DOUBLE) > 9000
      UNION ALL SELECT 'value', 'c_mktsegment', count(*) FROM dirty
        WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE', 'FURNITURE')
      UNION ALL SELECT 'value', 'c_name', count(*) FROM dirty
        WHERE NOT regexp_matches(c_name, '^(?:Customer#\\d+[0-6]$)')
      UNION ALL SELECT 'dtype', 'c_acctbal', count(*) FROM dirty
        WHERE c_acctbal IS NOT NULL AND try_cast(c_acctbal AS DOUBLE) IS NULL
      UNION ALL SELECT 'duplicate_key', 'c_nationkey,c_mktsegment', coalesce(sum(n), 0)::BIGINT FROM (
        SELECT count(*) AS n FROM dirty GROUP BY c_nationkey, c_mktsegment HAVING count(*) > 1)
      UNION ALL SELECT 'reference', 'c_nationkey', count(*) FROM dirty
        WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 10 <> 3))
"""
)


def _some_nations(spark: SparkSession, folder: str) -> DataFrame:
    return without_keys(table(spark, folder, "nation"), "n_nationkey", "n_nationkey % 10 = 3")


@query(
    "validate_table_report",
    "WITH"
    + _CUSTOMER_FINDINGS
    + """SELECT 'customer' AS "table", "check", "column", violations FROM findings
         WHERE violations > 0 OR "check" = 'rows'""",
)
def validate_table_report(spark: SparkSession, folder: str) -> DataFrame:
    tables = {"customer": dirty_customer(spark, folder), "nation": _some_nations(spark, folder)}
    report = validate.table_report(tables["customer"], "customer", CUSTOMER_RULES, tables, CUSTOMER_TYPES)
    return report.fillna("-", subset=["column"])


@query(
    "validate_null_counts",
    "WITH"
    + _DIRTY_CUSTOMER
    + """SELECT 'c_name' AS "column", count(*) FILTER (WHERE c_name IS NULL) AS violations FROM dirty
         UNION ALL SELECT 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment IS NULL) FROM dirty""",
)
def validate_null_counts(spark: SparkSession, folder: str) -> DataFrame:
    rules = TableRules(not_null=("c_custkey", "c_name", "c_mktsegment"))
    checks = validate.row_checks(dirty_customer(spark, folder), "customer", rules)
    return checks.filter("check = 'null' and violations > 0").select("column", "violations")


@query(
    "validate_value_rules",
    """
    SELECT count(*) FILTER (WHERE p_size < 5 OR p_size > 40) AS size_out_of_range,
           count(*) FILTER (WHERE p_type NOT IN ('ECONOMY', 'STANDARD', 'PROMO')) AS unknown_type,
           count(*) FILTER (WHERE NOT regexp_matches(p_brand, '^(?:Brand#1)')) AS odd_brand,
           count(*) FILTER (WHERE p_name NOT IN ('red widget') AND p_name IS NOT NULL
                            OR NOT regexp_matches(p_name, '^(?:[a-m])')) AS name_breaks_either
    FROM part
    """,
)
def validate_value_rules(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    types = dict(part.dtypes)
    rules = {
        "size_out_of_range": ("p_size", ValueRule(minimum=5, maximum=40)),
        "unknown_type": ("p_type", ValueRule(allowed=("ECONOMY", "STANDARD", "PROMO"))),
        "odd_brand": ("p_brand", ValueRule(pattern="Brand#1")),
        "name_breaks_either": ("p_name", ValueRule(allowed=("red widget",), pattern="[a-m]")),
    }
    return part.agg(
        *[F.count_if(validate.breaks_rule(F.col(c), types[c], r)).alias(name) for name, (c, r) in rules.items()]
    )


@query(
    "validate_duplicate_keys",
    """
    SELECT l_orderkey, l_partkey, count(*) AS rows FROM lineitem
    GROUP BY l_orderkey, l_partkey HAVING count(*) > 1
    """,
)
def validate_duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return validate.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_partkey"])


@query(
    "validate_duplicate_key_sample",
    """
    SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1
    ORDER BY l_orderkey, l_linenumber LIMIT 5
    """,
)
def validate_duplicate_key_sample(spark: SparkSession, folder: str) -> DataFrame:
    return validate.duplicate_key_sample(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "validate_broken_references",
    """
    SELECT o_custkey, count(*) AS rows FROM orders
    WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 3)
    GROUP BY o_custkey
    """,
)
def validate_broken_references(spark: SparkSession, folder: str) -> DataFrame:
    parents = without_keys(table(spark, folder, "customer"), "c_custkey", "c_custkey % 10 = 3")
    return validate.broken_references(
        table(spark, folder, "orders"), parents, Reference("o_custkey", "customer", "c_custkey")
    )


ORDERS_RULES = TableRules(
    unique_key=("o_orderkey",),
    not_null=("o_orderkey", "o_custkey"),
    values={"o_totalprice": ValueRule(maximum=450000)},
    references=(Reference("o_custkey", "customer", "c_custkey"),),
)
LINEITEM_RULES = TableRules(
    unique_key=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
    not_null=("l_orderkey",),
    values={"l_quantity": ValueRule(minimum=1, maximum=50)},
    references=(Reference("l_orderkey", "orders", "o_orderkey"),),
)


def _corpus_report(spark: SparkSession, folder: str) -> DataFrame:
    tables = {
        "customer": dirty_customer(spark, folder),
        "nation": _some_nations(spark, folder),
        "orders": table(spark, folder, "orders"),
        "lineitem": table(spark, folder, "lineitem"),
    }
    rules = {"customer": CUSTOMER_RULES, "orders": ORDERS_RULES, "lineitem": LINEITEM_RULES}
    return validate.validate(tables, rules, {"customer": CUSTOMER_TYPES})


_CORPUS_FINDINGS = (
    _CUSTOMER_FINDINGS
    + """,
    corpus AS (
      SELECT 'customer' AS "table", "check", "column", violations FROM findings
      UNION ALL SELECT 'nation', 'rows', '-', count(*) FROM nation
      UNION ALL SELECT 'nation', 'no_rules', '-', 0
      UNION ALL SELECT 'orders', 'rows', '-', count(*) FROM orders
      UNION ALL SELECT 'orders', 'value', 'o_totalprice', count(*) FROM orders WHERE o_totalprice > 450000
      UNION ALL SELECT 'orders', 'duplicate_key', 'o_orderkey', count(*) - count(DISTINCT o_orderkey) FROM orders
      UNION ALL SELECT 'orders', 'reference', 'o_custkey', count(*) FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
      UNION ALL SELECT 'lineitem', 'rows', '-', count(*) FROM lineitem
      UNION ALL SELECT 'lineitem', 'value', 'l_quantity', count(*) FROM lineitem WHERE l_quantity NOT BETWEEN 1 AND 50
      UNION ALL SELECT 'lineitem', 'duplicate_key', 'key', coalesce(sum(n), 0)::BIGINT FROM (
        SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber HAVING count(*) > 1)
      UNION ALL SELECT 'lineitem', 'reference', 'l_orderkey', count(*) FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
"""
)


@query(
    "validate_verdicts",
    "WITH"
    + _CORPUS_FINDINGS
    + """
    SELECT "table", sum(violations) FILTER (WHERE "check" = 'rows')::BIGINT AS rows,
           count(*) FILTER (WHERE "check" = 'no_rules') = 0 AS rules_defined,
           coalesce(sum(violations) FILTER (WHERE "check" NOT IN ('rows', 'no_rules')), 0) = 0 AS passed
    FROM corpus GROUP BY "table"
    """,
)
def validate_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return validate.table_verdicts(_corpus_report(spark, folder))


@query(
    "validate_summary",
    "WITH"
    + _CORPUS_FINDINGS
    + """,
    per_table AS (
      SELECT "table", count(*) FILTER (WHERE "check" = 'no_rules') > 0 AS skipped,
             coalesce(sum(violations) FILTER (WHERE "check" NOT IN ('rows', 'no_rules')), 0) > 0 AS failed
      FROM corpus GROUP BY "table"),
    totals AS (SELECT "check", sum(violations)::BIGINT AS v FROM corpus GROUP BY "check")
    SELECT count(*) AS tables, count(*) FILTER (WHERE NOT failed AND NOT skipped) AS tables_passed,
           count(*) FILTER (WHERE failed) AS tables_failed, count(*) FILTER (WHERE skipped) AS tables_skipped,
           (SELECT v FROM totals WHERE "check" = 'structure') AS structural_issues,
           (SELECT v FROM totals WHERE "check" = 'null') AS null_violations,
           (SELECT v FROM totals WHERE "check" = 'duplicate_key') AS duplicate_key_rows,
           (SELECT v FROM totals WHERE "check" = 'value') AS invalid_values,
           (SELECT v FROM totals WHERE "check" = 'dtype') AS dtype_issues,
           (SELECT v FROM totals WHERE "check" = 'reference') AS broken_references
    FROM per_table
    """,
)
def validate_summary(spark: SparkSession, folder: str) -> DataFrame:
    return validate.summary(_corpus_report(spark, folder))


@query(
    "validate_by_version",
    """
    WITH versions AS (
      SELECT 'Version_1' AS dataset_version, * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
      UNION ALL SELECT 'Version_2', * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
    parents AS (
      SELECT 'Version_1' AS dataset_version, c_custkey FROM customer WHERE c_custkey % 10 <> 3
      UNION ALL SELECT 'Version_2', c_custkey FROM customer WHERE c_custkey % 10 <> 4)
    SELECT dataset_version, 'rows' AS "check", count(*) AS violations FROM versions GROUP BY ALL
    UNION ALL
    SELECT dataset_version, 'value', count(*) FROM versions WHERE o_totalprice > 450000 GROUP BY ALL
    UNION ALL
    SELECT v.dataset_version, 'reference', count(*) FROM versions v ANTI JOIN parents p
      ON v.dataset_version = p.dataset_version AND v.o_custkey = p.c_custkey GROUP BY ALL
    """,
)
def validate_by_version(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    v1, v2 = F.lit("Version_1"), F.lit("Version_2")
    versions = orders.filter("o_orderdate < '1999-01-01'").withColumn("dataset_version", v1)
    versions = versions.unionByName(orders.filter("o_orderdate >= '1998-01-01'").withColumn("dataset_version", v2))
    parents = without_keys(customer, "c_custkey", "c_custkey % 10 = 3").withColumn("dataset_version", v1)
    parents = parents.unionByName(without_keys(customer, "c_custkey", "c_custkey % 10 = 4").withColumn("dataset_version", v2))
    tables = {"orders": versions, "customer": parents}
    report = validate.table_report(versions, "orders", ORDERS_RULES, tables, scope=("dataset_version",))
    return report.select("dataset_version", "check", "violations")


# -------------------------------------------------------------------- cleaning

# white space the way Spark's (?U)\s and the control separators define it
_SQL_BLANKS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"


@query(
    "clean_document_texts",
    rf"""
    WITH padded AS (
      SELECT doc_id, '  ' || text || chr(160) || chr(9) AS text FROM documents),
    cleaned AS (
      SELECT doc_id, text, trim(lower(regexp_replace(text, '{_SQL_BLANKS}', ' ', 'g'))) AS clean FROM padded)
    SELECT doc_id, length(clean) AS characters, md5(clean) AS digest, CAST(text <> clean AS INT) AS changed FROM cleaned
    """,
)
def clean_document_texts(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select(
        "doc_id", F.concat(F.lit("  "), "text", F.lit(" \t")).alias("text")
    )
    rule = CleaningRule(lowercase=("text",))
    changed = clean.strings_changed(documents, rule)
    flagged = documents.withColumn("changed", changed)
    return clean.clean_strings(flagged, rule).select(
        "doc_id", F.length("text").cast("bigint").alias("characters"), F.md5("text").alias("digest"), "changed"
    )


@query(
    "clean_null_tokens",
    """
    WITH raw AS (
      SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN ' nan ' WHEN 1 THEN 'None' WHEN 2 THEN '<NA>'
                        WHEN 3 THEN '   ' WHEN 4 THEN 'NONE' ELSE '  ' || p_name || '  x ' END AS name FROM part),
    cleaned AS (SELECT *, nullif(nullif(nullif(nullif(
      trim(regexp_replace(name, '\\s+', ' ', 'g')), 'nan'), 'None'), '<NA>'), '') AS clean FROM raw)
    SELECT coalesce(clean, '(null)') AS name, count(*) AS rows,
           count(*) FILTER (WHERE name IS DISTINCT FROM clean) AS changed
    FROM cleaned GROUP BY clean
    """,
)
def clean_null_tokens(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("p_partkey") % 6
    texts = {0: " nan ", 1: "None", 2: "<NA>", 3: "   ", 4: "NONE"}
    name = F.concat(F.lit("  "), "p_name", F.lit("  x "))
    for value, text in texts.items():
        name = F.when(kind == value, text).otherwise(name)
    raw = table(spark, folder, "part").select(name.alias("name"))
    flagged = raw.withColumn("_changed", clean.strings_changed(raw, CleaningRule()))
    cleaned = clean.clean_strings(flagged, CleaningRule())
    return cleaned.groupBy(F.coalesce("name", F.lit("(null)")).alias("name")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_changed").alias("changed")
    )


@query(
    "clean_null_policies",
    "WITH"
    + _DIRTY_CUSTOMER
    + """SELECT c_custkey, coalesce(c_name, 'Unknown Customer') AS c_name, c_mktsegment FROM dirty
         WHERE c_mktsegment IS NOT NULL""",
)
def clean_null_policies(spark: SparkSession, folder: str) -> DataFrame:
    rule = CleaningRule(
        null_policies={
            "c_name": NullPolicy.FILL_DEFAULT,
            "c_mktsegment": NullPolicy.DROP_ROW,
            "c_acctbal": NullPolicy.LEAVE,
        },
        fill_values={"c_name": "Unknown Customer"},
    )
    return clean.handle_nulls(dirty_customer(spark, folder), rule).select("c_custkey", "c_name", "c_mktsegment")


@query(
    "clean_bounds_drop_row",
    "SELECT c_custkey, c_acctbal FROM customer WHERE NOT (c_acctbal < 0) AND NOT (c_nationkey < 3)",
)
def clean_bounds_drop_row(spark: SparkSession, folder: str) -> DataFrame:
    rule = CleaningRule(
        minimums={"c_acctbal": 0.0, "c_nationkey": 3.0}, invalid_values=InvalidValuePolicy.DROP_ROW
    )
    return clean.handle_invalid(table(spark, folder, "customer"), rule).select("c_custkey", "c_acctbal")


@query(
    "clean_bounds_nullify",
    """
    SELECT c_mktsegment, count(*) AS rows, count(CASE WHEN c_acctbal >= 0 THEN 1 END) AS kept,
           round(sum(CASE WHEN c_acctbal >= 0 THEN c_acctbal END), 2) AS total FROM customer GROUP BY c_mktsegment
    """,
)
def clean_bounds_nullify(spark: SparkSession, folder: str) -> DataFrame:
    rule = CleaningRule(minimums={"c_acctbal": 0.0}, invalid_values=InvalidValuePolicy.NULLIFY)
    cleaned = clean.handle_invalid(table(spark, folder, "customer"), rule)
    return cleaned.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("c_acctbal").alias("kept"),
        F.round(F.sum("c_acctbal"), 2).alias("total"),
    )


def _keyed_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


_LINES = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem"
_ORDER = ("l_partkey", "l_suppkey", "l_quantity")
_BY_KEY = "PARTITION BY l_orderkey, l_linenumber"


@query(
    "clean_duplicates_keep_first",
    f"{_LINES} QUALIFY row_number() OVER ({_BY_KEY} ORDER BY l_partkey, l_suppkey, l_quantity) = 1",
)
def clean_duplicates_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    rule = CleaningRule(key=("l_orderkey", "l_linenumber"))
    return clean.remove_duplicates(_keyed_lines(spark, folder), rule, _ORDER)


@query(
    "clean_duplicates_keep_last",
    f"{_LINES} QUALIFY row_number() OVER ({_BY_KEY} ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC) = 1",
)
def clean_duplicates_keep_last(spark: SparkSession, folder: str) -> DataFrame:
    rule = CleaningRule(key=("l_orderkey", "l_linenumber"), duplicates=DuplicatePolicy.KEEP_LAST)
    return clean.remove_duplicates(_keyed_lines(spark, folder), rule, _ORDER)


@query("clean_duplicates_drop_all", f"{_LINES} QUALIFY count(*) OVER ({_BY_KEY}) = 1")
def clean_duplicates_drop_all(spark: SparkSession, folder: str) -> DataFrame:
    rule = CleaningRule(key=("l_orderkey", "l_linenumber"), duplicates=DuplicatePolicy.DROP_ALL)
    return clean.remove_duplicates(_keyed_lines(spark, folder), rule, _ORDER)


@query("clean_duplicate_texts", "SELECT md5(text) AS digest FROM documents GROUP BY text")
def clean_duplicate_texts(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "documents").select("text")
    return clean.remove_duplicates(texts, CleaningRule(), ()).select(F.md5("text").alias("digest"))


@query(
    "clean_mixed_key_types",
    """
    WITH texts AS (
      SELECT CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) WHEN 1 THEN (o_orderkey - 1) || '.0'
             WHEN 2 THEN ' ' || (o_orderkey - 2) || ' ' WHEN 3 THEN (o_orderkey - 3) || '.5'
             ELSE 'order ' || o_orderkey END AS k FROM orders),
    numbers AS (SELECT k, try_cast(trim(k) AS DOUBLE) AS x FROM texts)
    SELECT CAST(CASE WHEN x = floor(x) THEN x ELSE NULL END AS BIGINT) AS order_id FROM numbers
    WHERE x = floor(x) GROUP BY 1
    """,
)
def clean_mixed_key_types(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    text = (
        F.when(key % 5 == 0, key.cast("string"))
        .when(key % 5 == 1, F.concat((key - 1).cast("string"), F.lit(".0")))
        .when(key % 5 == 2, F.concat(F.lit(" "), (key - 2).cast("string"), F.lit(" ")))
        .when(key % 5 == 3, F.concat((key - 3).cast("string"), F.lit(".5")))
        .otherwise(F.concat(F.lit("order "), key.cast("string")))
    )
    texts = table(spark, folder, "orders").select(text.alias("order_id"))
    typed = clean.convert_types(texts, CanonicalSchema((C("order_id", "bigint"),)))
    rule = CleaningRule(key=("order_id",), null_policies={"order_id": NullPolicy.DROP_ROW})
    return dedupe.first_per_key(clean.handle_nulls(typed, rule), ["order_id"], ["order_id"])


@query(
    "clean_conversion_losses",
    "WITH"
    + _DIRTY_CUSTOMER
    + """SELECT 'c_acctbal' AS "column", count(*) AS lost FROM dirty WHERE try_cast(c_acctbal AS DOUBLE) IS NULL""",
)
def clean_conversion_losses(spark: SparkSession, folder: str) -> DataFrame:
    return clean.conversion_losses(dirty_customer(spark, folder), CUSTOMER_TYPES)


CHAIN_RULES = {
    "nation": CleaningRule(key=("n_nationkey",)),
    "customer": CleaningRule(
        key=("c_custkey",),
        null_policies={"c_name": NullPolicy.FILL_DEFAULT, "c_mktsegment": NullPolicy.DROP_ROW},
        fill_values={"c_name": "Unknown Customer"},
        lowercase=("c_mktsegment",),
        references=(Reference("c_nationkey", "nation", "n_nationkey"),),
    ),
    "orders": CleaningRule(
        key=("o_orderkey",),
        references=(Reference("o_custkey", "customer", "c_custkey"),),
        minimums={"o_totalprice": 20000.0},
        invalid_values=InvalidValuePolicy.DROP_ROW,
    ),
}


def _chain(spark: SparkSession, folder: str) -> dict[str, clean.CleanedTable]:
    key = F.col("o_orderkey")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.when(key % 17 == 0, None).otherwise(F.col("o_custkey")).alias("o_custkey"), "o_totalprice"
    )
    # every 9th order is delivered twice
    repeated = orders.unionByName(orders.filter(key % 9 == 0))
    tables = {
        "orders": repeated.withColumn("_order", F.col("o_totalprice")),
        "customer": dirty_customer(spark, folder).withColumn("_order", F.col("c_custkey")),
        "nation": _some_nations(spark, folder).select("n_nationkey", "n_name").withColumn("_order", F.lit(1)),
    }
    cleaned, failed = clean.clean_all(tables, CHAIN_RULES, order_by=("_order",))
    if failed:
        raise ValueError(failed)
    return cleaned


_CHAIN_SQL = (
    _DIRTY_CUSTOMER
    + """,
    clean_customer AS (
      SELECT c_custkey FROM dirty WHERE c_mktsegment IS NOT NULL
        AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 10 <> 3)),
    one AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_totalprice FROM orders),
    repeated AS (SELECT * FROM one UNION ALL SELECT * FROM one WHERE o_orderkey % 9 = 0),
    bounded AS (SELECT * FROM repeated WHERE NOT (o_totalprice < 20000)),
    uniq AS (SELECT DISTINCT * FROM bounded),
    kept AS (SELECT * FROM uniq WHERE o_custkey IS NULL OR o_custkey IN (SELECT c_custkey FROM clean_customer))
"""
)


@query(
    "clean_orphans_chained",
    "WITH" + _CHAIN_SQL + "SELECT o_orderkey, coalesce(o_custkey, -1) AS o_custkey, o_totalprice FROM kept",
)
def clean_orphans_chained(spark: SparkSession, folder: str) -> DataFrame:
    return _chain(spark, folder)["orders"].result.drop("_order").fillna(-1, subset=["o_custkey"])


_CHAIN_REPORT_SQL = (
    _CHAIN_SQL
    + """,
    reports AS (
      SELECT 'orders' AS "table", (SELECT count(*) FROM repeated) AS rows_before, (SELECT count(*) FROM kept) AS rows_after,
             0::BIGINT AS strings_modified, 0::BIGINT AS null_rows_dropped, 0::BIGINT AS nulls_filled,
             (SELECT count(*) FROM repeated WHERE o_totalprice < 20000) AS invalid_values_handled,
             (SELECT count(*) FROM bounded) - (SELECT count(*) FROM uniq) AS duplicates_removed,
             (SELECT count(*) FROM uniq) - (SELECT count(*) FROM kept) AS orphan_rows_removed
      UNION ALL
      SELECT 'customer', (SELECT count(*) FROM dirty), (SELECT count(*) FROM clean_customer),
             (SELECT count(*) FROM dirty WHERE c_mktsegment <> lower(c_mktsegment)),
             (SELECT count(*) FROM dirty WHERE c_mktsegment IS NULL),
             (SELECT count(*) FROM dirty WHERE c_mktsegment IS NOT NULL AND c_name IS NULL), 0, 0,
             (SELECT count(*) FROM dirty WHERE c_mktsegment IS NOT NULL) - (SELECT count(*) FROM clean_customer))
"""
)


@query(
    "clean_report",
    "WITH" + _CHAIN_REPORT_SQL + "SELECT *, rows_before - rows_after AS rows_removed FROM reports",
)
def clean_report(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = _chain(spark, folder)
    return clean.cleaning_report(cleaned["orders"]).unionByName(clean.cleaning_report(cleaned["customer"]))


@query(
    "clean_summary",
    "WITH"
    + _CHAIN_REPORT_SQL
    + """
    SELECT count(*) AS tables, sum(rows_before)::BIGINT AS rows_before, sum(rows_after)::BIGINT AS rows_after,
           sum(strings_modified)::BIGINT AS strings_modified, sum(nulls_filled)::BIGINT AS nulls_filled,
           sum(invalid_values_handled)::BIGINT AS invalid_values_handled,
           sum(duplicates_removed)::BIGINT AS duplicates_removed,
           sum(rows_before - rows_after)::BIGINT AS rows_removed,
           sum(orphan_rows_removed)::BIGINT AS orphan_rows_removed,
           round(100.0 * sum(rows_before - rows_after) / sum(rows_before), 6) AS percent_removed
    FROM reports
    """,
)
def clean_summary(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = _chain(spark, folder)
    reports = clean.cleaning_report(cleaned["orders"]).unionByName(clean.cleaning_report(cleaned["customer"]))
    return rounded(clean.cleaning_summary(reports))


@query(
    "clean_twice_changes_nothing",
    "WITH" + _CHAIN_SQL + "SELECT count(*) AS rows_before, count(*) AS rows_after FROM kept",
)
def clean_twice_changes_nothing(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = _chain(spark, folder)
    parents = {name: c.result for name, c in cleaned.items()}
    again = clean.clean_table(
        cleaned["orders"].result, "orders", CHAIN_RULES["orders"], parents, order_by=("_order",)
    )
    return clean.cleaning_report(again).select("rows_before", "rows_after")


@query(
    "clean_integer_conversion",
    """
    SELECT l_linenumber, count(*) AS rows, count(CASE WHEN q = floor(q) THEN 1 END) AS whole_values
    FROM (SELECT l_linenumber, l_quantity / 2 AS q FROM lineitem) GROUP BY l_linenumber
    """,
)
def clean_integer_conversion(spark: SparkSession, folder: str) -> DataFrame:
    half = table(spark, folder, "lineitem").select("l_linenumber", (F.col("l_quantity") / 2).alias("q"))
    return half.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("rows"), F.count(X.to_long(F.col("q"), "double")).alias("whole_values")
    )
