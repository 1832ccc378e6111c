"""Profiles and comparisons on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.operators import master, profile
from sievewright.queries.masters import order_versions
from sievewright.queries.quality import dirty_customer
from sievewright.queries.registry import query, rounded, table

_DIRTY = """
    dirty AS (
      SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS c_name,
             CASE WHEN c_custkey % 11 = 0 THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR) END AS c_acctbal,
             CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_nationkey
      FROM customer)
"""


def _profile_sql(source: str, columns: dict[str, str]) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls,
        round(100.0 * (count(*) - count({c})) / count(*), 6) AS null_percent, count(DISTINCT {c}) AS distinct_values,
        round(100.0 * count(DISTINCT {c}) / count(*), 6) AS distinct_percent FROM {source}"""
        for c, t in columns.items()
    ]
    return " UNION ALL ".join(parts)


@query(
    "profile_columns",
    f"WITH {_DIRTY} "
    + _profile_sql(
        "dirty",
        {"c_custkey": "bigint", "c_name": "string", "c_acctbal": "string", "c_mktsegment": "string", "c_nationkey": "int"},
    ),
)
def profile_columns(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.column_profile(dirty_customer(spark, folder)))


@query(
    "profile_lineitem",
    _profile_sql(
        "lineitem",
        {
            "l_orderkey": "bigint",
            "l_partkey": "bigint",
            "l_suppkey": "bigint",
            "l_linenumber": "int",
            "l_quantity": "double",
            "l_extendedprice": "double",
            "l_discount": "double",
            "l_tax": "double",
            "l_returnflag": "string",
            "l_linestatus": "string",
            "l_shipdate": "timestamp_ntz",
        },
    ),
)
def profile_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.column_profile(table(spark, folder, "lineitem")))


@query(
    "profile_missing_summary",
    f"""
    WITH {_DIRTY}
    SELECT * FROM (
      SELECT 'c_name' AS "column", count(*) - count(c_name) AS nulls,
             round(100.0 * (count(*) - count(c_name)) / count(*), 6) AS null_percent FROM dirty
      UNION ALL
      SELECT 'c_mktsegment', count(*) - count(c_mktsegment),
             round(100.0 * (count(*) - count(c_mktsegment)) / count(*), 6) FROM dirty)
    """,
)
def profile_missing_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.missing_summary(dirty_customer(spark, folder)))


@query(
    "profile_duplicate_rows",
    """
    SELECT count(*) AS rows, count(*) - count(DISTINCT (text, lang)) AS duplicates,
           round(100.0 * (count(*) - count(DISTINCT (text, lang))) / count(*), 6) AS duplicate_percent FROM documents
    """,
)
def profile_duplicate_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.duplicate_rows(table(spark, folder, "documents"), ["text", "lang"]))


@query(
    "profile_duplicate_keys",
    """
    SELECT "table", rows, rows - keys AS duplicates, round(100.0 * (rows - keys) / rows, 6) AS duplicate_percent FROM (
      SELECT 'lineitem' AS "table", count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS keys FROM lineitem
      UNION ALL SELECT 'orders', count(*), count(DISTINCT o_orderkey) FROM orders
      UNION ALL SELECT 'labels', count(*), count(DISTINCT quality) FROM labels
      UNION ALL SELECT 'conversations', count(*), count(DISTINCT conv_id) FROM conversations)
    """,
)
def profile_duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    keys = {
        "lineitem": ["l_orderkey", "l_linenumber"],
        "orders": ["o_orderkey"],
        "labels": ["quality"],
        "conversations": ["conv_id"],
    }
    return rounded(profile.duplicate_key_counts({n: (table(spark, folder, n), k) for n, k in keys.items()}))


@query(
    "profile_value_counts",
    f"""
    WITH {_DIRTY}
    SELECT coalesce(c_mktsegment, '-') AS c_mktsegment, count(*) AS rows,
           round(100.0 * count(*) / (SELECT count(*) FROM dirty), 6) AS percent FROM dirty GROUP BY 1
    """,
)
def profile_value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.value_counts(dirty_customer(spark, folder), "c_mktsegment")).fillna("-")


@query(
    "profile_top_values",
    "SELECT l_partkey, count(*) AS rows FROM lineitem GROUP BY l_partkey ORDER BY rows DESC, l_partkey LIMIT 20",
)
def profile_top_values(spark: SparkSession, folder: str) -> DataFrame:
    return profile.top_values(table(spark, folder, "lineitem"), "l_partkey", 20)


@query(
    "profile_largest_and_smallest",
    """
    (SELECT 'largest' AS side, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20)
    UNION ALL
    (SELECT 'smallest', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20)
    """,
)
def profile_largest_and_smallest(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    sides = [
        profile.extreme_rows(orders, "o_totalprice", 20, ["o_orderkey"], largest).select(F.lit(name).alias("side"), "*")
        for name, largest in (("largest", True), ("smallest", False))
    ]
    return sides[0].unionByName(sides[1])


# The percentiles of the value reports.
PERCENTILES = {"p1": 0.01, "p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99, "p99_9": 0.999}
_PERCENTILES_SQL = ", ".join(f"round(quantile_cont(x, {p}), 4) AS {n}" for n, p in PERCENTILES.items())


@query(
    "profile_describe",
    f"""
    WITH v AS (SELECT try_cast(CASE WHEN c_custkey % 11 = 0 THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR) END AS DOUBLE) AS x FROM customer)
    SELECT count(x) AS count, count(*) - count(x) AS missing, round(100.0 * (count(*) - count(x)) / count(*), 4) AS missing_percent,
           min(x) AS min, max(x) AS max, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std,
           count(*) FILTER (WHERE x = 0) AS zeros, count(*) FILTER (WHERE x < 0) AS negatives, {_PERCENTILES_SQL} FROM v
    """,
)
def profile_describe(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.describe(dirty_customer(spark, folder), "c_acctbal", PERCENTILES), 4)


@query(
    "profile_describe_by_group",
    f"""
    SELECT event_type, count(x) AS count, count(*) - count(x) AS missing, 0.0::DOUBLE AS missing_percent, min(x) AS min, max(x) AS max,
           round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, count(*) FILTER (WHERE x = 0) AS zeros,
           count(*) FILTER (WHERE x < 0) AS negatives, {_PERCENTILES_SQL}
    FROM (SELECT event_type, value AS x FROM events) GROUP BY event_type
    """,
)
def profile_describe_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.describe(table(spark, folder, "events"), "value", PERCENTILES, ["event_type"]), 4)


@query(
    "profile_shape",
    """
    WITH v AS (SELECT l_extendedprice AS x, ln(1 + l_extendedprice) AS y FROM lineitem),
    m AS (SELECT avg(x) AS mx, avg(y) AS my FROM v),
    p AS (SELECT avg((x - mx) ** 2) AS x2, avg((x - mx) ** 3) AS x3, avg((x - mx) ** 4) AS x4,
                 avg((y - my) ** 2) AS y2, avg((y - my) ** 3) AS y3, avg((y - my) ** 4) AS y4 FROM v, m)
    SELECT round(x3 / x2 ** 1.5, 6) AS skewness, round(x4 / x2 ** 2 - 3, 6) AS kurtosis,
           round(y3 / y2 ** 1.5, 6) AS log_skewness, round(y4 / y2 ** 2 - 3, 6) AS log_kurtosis FROM p
    """,
)
def profile_shape(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.shape(table(spark, folder, "lineitem"), "l_extendedprice"))


@query(
    "profile_cardinalities",
    """
    SELECT n AS rows_per_key, count(*) AS keys FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey) GROUP BY n
    """,
)
def profile_cardinalities(spark: SparkSession, folder: str) -> DataFrame:
    return profile.cardinalities(table(spark, folder, "lineitem"), "l_orderkey")


@query(
    "profile_cardinality_summary",
    """
    SELECT count(*) AS keys, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std, min(n) AS min, max(n) AS max,
           quantile_cont(n, 0.25) AS p25, quantile_cont(n, 0.5) AS median, quantile_cont(n, 0.75) AS p75
    FROM (SELECT count(*)::DOUBLE AS n FROM orders GROUP BY o_custkey)
    """,
)
def profile_cardinality_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.cardinality_summary(table(spark, folder, "orders"), "o_custkey"))


# -------------------------------------------------------------------- versions

_ORDER_VERSIONS = """
    a AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
    b AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
"""


@query(
    "compare_schemas",
    f"""
    WITH {_ORDER_VERSIONS}
    SELECT c AS "column", status, type_a, type_b, non_null_a, non_null_b FROM (
      SELECT 'o_orderkey' AS c, 'common' AS status, 'bigint' AS type_a, 'bigint' AS type_b,
             (SELECT count(o_orderkey) FROM a) AS non_null_a, (SELECT count(o_orderkey) FROM b) AS non_null_b
      UNION ALL SELECT 'o_custkey', 'retyped', 'bigint', 'string', (SELECT count(*) FROM a), (SELECT count(*) FROM b)
      UNION ALL SELECT 'o_totalprice', 'common', 'double', 'double', (SELECT count(*) FROM a), (SELECT count(*) FROM b)
      UNION ALL SELECT 'o_orderpriority', 'removed', 'string', '-', (SELECT count(*) FROM a), -1
      UNION ALL SELECT 'o_orderstatus', 'added', '-', 'string', -1, (SELECT count(*) FROM b))
    """,
)
def compare_schemas(spark: SparkSession, folder: str) -> DataFrame:
    versions = order_versions(spark, folder)
    retyped = versions["Version_2"].withColumn("o_custkey", F.col("o_custkey").cast("string"))
    difference = profile.schema_difference(versions["Version_1"], retyped)
    return difference.fillna("-").fillna(-1)


@query(
    "compare_nulls",
    f"""
    WITH {_ORDER_VERSIONS},
    na AS (SELECT count(*) FILTER (WHERE o_totalprice < 50000) AS n, count(*) AS t FROM a),
    nb AS (SELECT count(*) FILTER (WHERE o_totalprice < 90000) AS n, count(*) AS t FROM b)
    SELECT 'o_orderkey' AS "column", 0 AS nulls_a, 0.0::DOUBLE AS null_percent_a, 0 AS nulls_b, 0.0::DOUBLE AS null_percent_b
    UNION ALL SELECT 'price', na.n, round(100.0 * na.n / na.t, 6), nb.n, round(100.0 * nb.n / nb.t, 6) FROM na, nb
    UNION ALL SELECT 'o_orderpriority', 0, 0, -1, -1
    UNION ALL SELECT 'o_orderstatus', -1, -1, 0, 0
    """,
)
def compare_nulls(spark: SparkSession, folder: str) -> DataFrame:
    versions = order_versions(spark, folder)

    def gaps(df: DataFrame, limit: float, extra: str) -> DataFrame:
        return df.select("o_orderkey", F.when(F.col("o_totalprice") >= limit, F.col("o_totalprice")).alias("price"), extra)

    difference = profile.null_difference(
        gaps(versions["Version_1"], 50000, "o_orderpriority"), gaps(versions["Version_2"], 90000, "o_orderstatus")
    )
    return rounded(difference).fillna(-1)


@query(
    "compare_key_overlap",
    f"""
    WITH {_ORDER_VERSIONS},
    k AS (SELECT coalesce(x.k, y.k) AS k, x.k IS NOT NULL AS in_a, y.k IS NOT NULL AS in_b
          FROM (SELECT DISTINCT o_custkey AS k FROM a) x
          FULL JOIN (SELECT DISTINCT o_custkey AS k FROM b) y ON x.k = y.k)
    SELECT count(*) FILTER (WHERE in_a) AS keys_a, count(*) FILTER (WHERE in_b) AS keys_b,
           count(*) FILTER (WHERE in_a AND in_b) AS common, count(*) FILTER (WHERE NOT in_b) AS only_a,
           count(*) FILTER (WHERE NOT in_a) AS only_b,
           round(100.0 * count(*) FILTER (WHERE in_a AND in_b) / count(*) FILTER (WHERE in_a), 6) AS a_in_b_percent,
           round(100.0 * count(*) FILTER (WHERE in_a AND in_b) / count(*) FILTER (WHERE in_b), 6) AS b_in_a_percent
    FROM k
    """,
)
def compare_key_overlap(spark: SparkSession, folder: str) -> DataFrame:
    a, b = order_versions(spark, folder).values()
    return rounded(profile.key_overlap(a, b, ["o_custkey"]))


FOUR_VERSIONS = """
    four AS (
      SELECT o_custkey, 'Version_' || v AS dataset_version FROM orders, range(1, 5) t(v)
      WHERE year(o_orderdate) BETWEEN 1994 + v AND 1996 + v AND o_custkey % (v + 2) <> 0),
    pairs AS (SELECT DISTINCT o_custkey, dataset_version FROM four)
"""


def four_versions(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_custkey", F.year("o_orderdate").alias("year"))
    return master.union_versions(
        {f"Version_{v}": orders.filter(f"year BETWEEN {1994 + v} AND {1996 + v} AND o_custkey % {v + 2} <> 0") for v in range(1, 5)}
    )


@query(
    "compare_overlap_matrix",
    f"""
    WITH {FOUR_VERSIONS},
    sizes AS (SELECT dataset_version AS v, count(*) AS n FROM pairs GROUP BY 1)
    SELECT a.dataset_version AS version_a, b.dataset_version AS version_b, max(x.n) AS keys_a, max(y.n) AS keys_b,
           count(*) AS common, round(100.0 * count(*) / max(x.n), 6) AS a_in_b_percent
    FROM pairs a JOIN pairs b ON a.o_custkey = b.o_custkey AND a.dataset_version <> b.dataset_version
    JOIN sizes x ON x.v = a.dataset_version JOIN sizes y ON y.v = b.dataset_version GROUP BY 1, 2
    """,
)
def compare_overlap_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.overlap_matrix(four_versions(spark, folder), ["o_custkey"], "dataset_version"))


@query(
    "compare_version_sets",
    f"""
    WITH {FOUR_VERSIONS},
    sets AS (SELECT o_custkey, string_agg(dataset_version, '|' ORDER BY dataset_version) AS versions FROM pairs GROUP BY 1)
    SELECT versions, count(*) AS keys FROM sets GROUP BY 1
    """,
)
def compare_version_sets(spark: SparkSession, folder: str) -> DataFrame:
    masks, versions = profile.version_masks(four_versions(spark, folder), ["o_custkey"], "dataset_version")
    sets = profile.versions_of_masks(profile.mask_histogram(masks), versions)
    return sets.select(F.array_join("versions", "|").alias("versions"), "keys")


def _tagged_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return master.union_versions(
        {
            "Version_1": orders.filter("o_orderdate < '1999-01-01'"),
            "Version_2": orders.filter("o_orderdate >= '1998-01-01'"),
        }
    )


_TAGGED = """
    tagged AS (
      SELECT *, 'Version_1' AS dataset_version FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
      UNION ALL SELECT *, 'Version_2' FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
"""


@query(
    "compare_date_ranges",
    f"""
    WITH {_TAGGED}
    SELECT dataset_version, count(*) AS rows, strftime(min(o_orderdate), '%Y-%m-%d') AS earliest,
           strftime(max(o_orderdate), '%Y-%m-%d') AS latest FROM tagged GROUP BY dataset_version
    """,
)
def compare_date_ranges(spark: SparkSession, folder: str) -> DataFrame:
    ranges = profile.date_ranges(_tagged_orders(spark, folder), "dataset_version", "o_orderdate")
    return ranges.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("earliest", "latest")})


@query(
    "compare_in_several_versions",
    f"""
    WITH {_TAGGED}
    SELECT o_orderkey, count(DISTINCT dataset_version) AS versions FROM tagged GROUP BY o_orderkey
    HAVING count(DISTINCT dataset_version) > 1
    """,
)
def compare_in_several_versions(spark: SparkSession, folder: str) -> DataFrame:
    return profile.in_several_versions(_tagged_orders(spark, folder), ["o_orderkey"], "dataset_version")


@query(
    "compare_version_statistics",
    f"""
    WITH {_TAGGED}
    SELECT dataset_version, count(*) AS rows, round(avg((p IS NOT NULL)::INT), 6) AS available_rate,
           round(quantile_cont(p, 0.5), 6) AS median
    FROM (SELECT dataset_version, CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS p FROM tagged) GROUP BY dataset_version
    """,
)
def compare_version_statistics(spark: SparkSession, folder: str) -> DataFrame:
    tagged = _tagged_orders(spark, folder).withColumn("p", F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")))
    return rounded(profile.version_statistics(tagged, "dataset_version", "p"))


# ------------------------------------------------------------------- structure


@query(
    "profile_presence_combinations",
    """
    SELECT has_a, has_b, has_c, count(*) AS rows FROM (
      SELECT l_partkey % 2 = 0 AS has_a, l_suppkey % 3 = 0 AS has_b, l_quantity > 10 AS has_c FROM lineitem) GROUP BY ALL
    """,
)
def profile_presence_combinations(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        F.when(F.col("l_partkey") % 2 == 0, F.col("l_partkey")).alias("a"),
        F.when(F.col("l_suppkey") % 3 == 0, F.col("l_suppkey")).alias("b"),
        F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("c"),
    )
    return profile.presence_combinations(lines, ["a", "b", "c"])


@query(
    "profile_presence_disagreement",
    "SELECT count(*) FILTER (WHERE (l_partkey % 2 = 0) <> (l_suppkey % 3 = 0)) AS disagreeing_rows FROM lineitem",
)
def profile_presence_disagreement(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        F.when(F.col("l_partkey") % 2 == 0, F.col("l_partkey")).alias("a"),
        F.when(F.col("l_suppkey") % 3 == 0, F.col("l_suppkey")).alias("b"),
    )
    return profile.presence_disagreement(lines, "a", "b")


@query(
    "profile_cross_table",
    """
    SELECT *, round(rows / sum(rows) OVER (PARTITION BY o_orderpriority), 6) AS row_share FROM (
      SELECT o_orderpriority, o_orderstatus, count(*) AS rows FROM orders GROUP BY ALL)
    """,
)
def profile_cross_table(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.cross_table(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus"))


@query(
    "profile_pivot_counts",
    """
    SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'O') AS "O",
           count(*) FILTER (WHERE o_orderstatus = 'F') AS "F", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
    FROM orders GROUP BY o_orderpriority
    """,
)
def profile_pivot_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.pivot_counts(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus", ["O", "F", "P"])


@query(
    "profile_flag_consistency",
    """
    SELECT round(100.0 * avg(((l_returnflag = 'R') = (l_discount > 0.05))::INT), 6) AS agreement_percent,
           count(*) FILTER (WHERE (l_returnflag = 'R') <> (l_discount > 0.05)) AS exceptions FROM lineitem
    """,
)
def profile_flag_consistency(spark: SparkSession, folder: str) -> DataFrame:
    flag, derived = F.col("l_returnflag") == "R", F.col("l_discount") > 0.05
    return rounded(profile.flag_consistency(table(spark, folder, "lineitem"), flag, derived))


@query(
    "profile_flag_exceptions",
    "SELECT doc_id FROM labels WHERE (quality = 1) <> (toxic = 0)",
)
def profile_flag_exceptions(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    return profile.flag_exceptions(labels, F.col("quality") == 1, F.col("toxic") == 0).select("doc_id")


@query(
    "profile_seeded_sample",
    "SELECT event_id, event_type FROM events ORDER BY sha256('7|' || event_id), event_id LIMIT 200",
)
def profile_seeded_sample(spark: SparkSession, folder: str) -> DataFrame:
    return profile.seeded_sample(table(spark, folder, "events").select("event_id", "event_type"), ["event_id"], 200, 7)
