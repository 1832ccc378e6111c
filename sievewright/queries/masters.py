"""Master table, joins and feature store on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions import columns as X
from sievewright.operators import features, fingerprint, master, profile
from sievewright.queries.registry import query, rounded, table, without_keys
from sievewright.specs import BridgeJoin, DimensionJoin, FeatureConfig, SnapshotJoin

# ---------------------------------------------------------------- master table

# customers, some of them twice
_CUSTOMER_COPIES = """
    copies AS (
      SELECT c_custkey, c_name, c_mktsegment FROM customer
      UNION ALL SELECT c_custkey, c_name || ' copy', 'COPY' FROM customer WHERE c_custkey % 5 = 0)
"""


def _customer_copies(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    copies = customer.filter("c_custkey % 5 = 0").select(
        "c_custkey", F.concat("c_name", F.lit(" copy")).alias("c_name"), F.lit("COPY").alias("c_mktsegment")
    )
    return customer.unionByName(copies)


def _orders_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        "o_orderkey", F.when(key % 10 == 0, None).otherwise(F.col("o_custkey")).alias("o_custkey"), "o_totalprice"
    )


_ORDERS_WITH_GAPS = """
    fact AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_totalprice
             FROM orders)
"""

CUSTOMER_DIMENSION = DimensionJoin(
    "customer", "o_custkey", "c_custkey", rename={"c_name": "customer_name", "c_mktsegment": "o_totalprice"}
)


@query(
    "master_dimension",
    f"""
    WITH {_CUSTOMER_COPIES}, {_ORDERS_WITH_GAPS},
    one AS (SELECT * FROM copies QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY c_name) = 1)
    SELECT o_orderkey, o_totalprice, coalesce(c_name, '-') AS customer_name
    FROM fact LEFT JOIN one ON o_custkey = c_custkey
    """,
)
def master_dimension(spark: SparkSession, folder: str) -> DataFrame:
    tables = {"customer": _customer_copies(spark, folder)}
    state = master.build_master(
        _orders_with_gaps(spark, folder), tables, [CUSTOMER_DIMENSION], order_by=("c_name",)
    )
    # the renamed column collides with the fact and is left out
    return state.result.select("o_orderkey", "o_totalprice", F.coalesce("customer_name", F.lit("-")).alias("customer_name"))


@query(
    "master_dimension_null_safe",
    f"""
    WITH {_ORDERS_WITH_GAPS},
    dimension AS (SELECT CASE WHEN c_custkey = 7 THEN NULL ELSE c_custkey END AS k, c_name FROM customer)
    SELECT o_orderkey, coalesce(c_name, '-') AS c_name
    FROM fact LEFT JOIN dimension ON o_custkey IS NOT DISTINCT FROM k
    """,
)
def master_dimension_null_safe(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    customer = table(spark, folder, "customer").select(F.when(key != 7, key).alias("k"), "c_name")
    spec = DimensionJoin("customer", "o_custkey", "k")
    state = master.build_master(_orders_with_gaps(spark, folder), {"customer": customer}, [spec], null_safe=True)
    return state.result.select("o_orderkey", F.coalesce("c_name", F.lit("-")).alias("c_name"))


LATEST_ORDER = SnapshotJoin(
    "orders", "c_custkey", "o_custkey", latest_by="o_orderdate", rename={"o_totalprice": "last_price"}
)


@query(
    "master_snapshot",
    """
    WITH o AS (
      SELECT o_custkey, o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS d FROM orders),
    latest AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC NULLS LAST, o_orderkey) = 1)
    SELECT c_custkey, coalesce(o_totalprice, -1) AS last_price FROM customer LEFT JOIN latest ON c_custkey = o_custkey
    """,
)
def master_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    orders = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", F.when(key % 3 != 0, F.col("o_orderdate")).alias("o_orderdate")
    )
    state = master.build_master(
        table(spark, folder, "customer"), {"orders": orders}, snapshots=[LATEST_ORDER], order_by=("o_orderkey",)
    )
    return state.result.select("c_custkey", F.coalesce("last_price", F.lit(-1.0)).alias("last_price"))


@query(
    "master_first_row_per_key",
    """
    WITH first AS (
      SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1)
    SELECT c_custkey, coalesce(o_totalprice, -1) AS first_price FROM customer LEFT JOIN first ON c_custkey = o_custkey
    """,
)
def master_first_row_per_key(spark: SparkSession, folder: str) -> DataFrame:
    spec = SnapshotJoin(
        "orders", "c_custkey", "o_custkey", rename={"o_totalprice": "first_price"}, output=("first_price",)
    )
    state = master.build_master(
        table(spark, folder, "customer"), {"orders": table(spark, folder, "orders")}, snapshots=[spec], order_by=("o_orderkey",)
    )
    return state.result.select("c_custkey", F.coalesce("first_price", F.lit(-1.0)).alias("first_price"))


PART_NAMES = BridgeJoin(
    "lineitem", "o_orderkey", "l_partkey", "part", lookup="part", lookup_key="p_partkey", lookup_name="p_name", list_size=3
)


def _lines_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as a bridge: the key is called as in the fact, some values are null."""
    part = F.col("l_partkey")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.when(part % 50 != 0, part).alias("l_partkey")
    )


_BRIDGE_SQL = """
    pairs AS (
      SELECT l_orderkey AS k, p_name AS v, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
      WHERE l_partkey % 50 <> 0 GROUP BY ALL),
    tops AS (SELECT k, v FROM pairs QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, v) = 1),
    firsts AS (SELECT k, v FROM pairs QUALIFY row_number() OVER (PARTITION BY k ORDER BY v) <= 3),
    bridge AS (
      SELECT k, count(*) AS part_count, (SELECT v FROM tops WHERE tops.k = pairs.k) AS top_part,
             (SELECT string_agg(v, '|' ORDER BY v) FROM firsts WHERE firsts.k = pairs.k) AS part_list
      FROM pairs GROUP BY k)
"""


@query(
    "master_bridge",
    f"""
    WITH {_BRIDGE_SQL}
    SELECT o_orderkey, coalesce(part_count, 0) AS part_count, coalesce(top_part, '-') AS top_part,
           coalesce(part_list, '-') AS part_list
    FROM orders LEFT JOIN bridge ON k = o_orderkey
    """,
)
def master_bridge(spark: SparkSession, folder: str) -> DataFrame:
    tables = {"lineitem": _lines_of_orders(spark, folder), "part": table(spark, folder, "part")}
    state = master.build_master(table(spark, folder, "orders").select("o_orderkey"), tables, bridges=[PART_NAMES])
    return state.result.select(
        "o_orderkey",
        "part_count",
        F.coalesce("top_part", F.lit("-")).alias("top_part"),
        F.coalesce(F.array_join("part_list", "|"), F.lit("-")).alias("part_list"),
    )


@query(
    "master_bridge_raw_values",
    """
    WITH pairs AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
    SELECT user_id, count(*) AS event_count, arg_min(event_type, (-n, event_type)) AS top_event,
           string_agg(event_type, '|' ORDER BY event_type) AS event_list
    FROM pairs GROUP BY user_id
    """,
)
def master_bridge_raw_values(spark: SparkSession, folder: str) -> DataFrame:
    spec = BridgeJoin("events", "user_id", "event_type", "event")
    rows = master.bridge_rows(table(spark, folder, "events"), spec, {})
    return rows.withColumn("event_list", F.array_join("event_list", "|"))


@query(
    "master_bridge_without_top",
    """
    SELECT l_partkey, count(DISTINCT l_returnflag) AS flag_count FROM lineitem GROUP BY l_partkey
    """,
)
def master_bridge_without_top(spark: SparkSession, folder: str) -> DataFrame:
    spec = BridgeJoin("lineitem", "l_partkey", "l_returnflag", "flag", with_top=False, with_list=False)
    return master.bridge_rows(table(spark, folder, "lineitem"), spec, {})


def _full_master(spark: SparkSession, folder: str) -> master.Joined:
    customer = without_keys(table(spark, folder, "customer"), "c_custkey", "c_custkey % 10 = 3")
    latest_line = SnapshotJoin(
        "shipments", "o_orderkey", "l_orderkey", latest_by="l_shipdate", rename={"l_extendedprice": "last_line_price"}
    )
    shipments = table(spark, folder, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice", "l_partkey")
    tables = {
        "customer": customer.select("c_custkey", "c_name", "c_mktsegment"),
        "shipments": shipments,
        "lineitem": _lines_of_orders(spark, folder),
        "part": table(spark, folder, "part"),
    }
    return master.build_master(
        _orders_with_gaps(spark, folder),
        tables,
        [DimensionJoin("customer", "o_custkey", "c_custkey", rename={"c_name": "customer_name"})],
        [latest_line, SnapshotJoin("absent", "o_orderkey", "x"), SnapshotJoin("shipments", "o_orderkey", "l_orderkey", enabled=False)],
        [PART_NAMES],
        order_by=("l_extendedprice", "l_partkey"),
    )


_FULL_SQL = f"""
    {_ORDERS_WITH_GAPS}, {_BRIDGE_SQL},
    latest AS (SELECT * FROM lineitem QUALIFY row_number() OVER (
      PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice, l_partkey) = 1),
    full_master AS (
      SELECT fact.*, c_custkey, c_name, c_mktsegment, l_orderkey, l_shipdate, l_extendedprice, l_partkey, k, part_count, top_part, part_list
      FROM fact LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 10 <> 3) ON o_custkey = c_custkey
      LEFT JOIN latest ON l_orderkey = o_orderkey LEFT JOIN bridge ON k = o_orderkey)
"""


@query(
    "master_full",
    f"""
    WITH {_FULL_SQL}
    SELECT o_orderkey, o_totalprice, coalesce(c_name, '-') AS customer_name, coalesce(c_mktsegment, '-') AS c_mktsegment,
           coalesce(strftime(l_shipdate, '%Y-%m-%d'), '-') AS shipped, coalesce(part_count, 0) AS part_count,
           coalesce(top_part, '-') AS top_part, coalesce(part_list, '-') AS part_list
    FROM full_master
    """,
)
def master_full(spark: SparkSession, folder: str) -> DataFrame:
    dash = F.lit("-")
    return _full_master(spark, folder).result.select(
        "o_orderkey",
        "o_totalprice",
        F.coalesce("customer_name", dash).alias("customer_name"),
        F.coalesce("c_mktsegment", dash).alias("c_mktsegment"),
        F.coalesce(F.date_format("l_shipdate", "yyyy-MM-dd"), dash).alias("shipped"),
        "part_count",
        F.coalesce("top_part", dash).alias("top_part"),
        F.coalesce(F.array_join("part_list", "|"), dash).alias("part_list"),
    )


@query(
    "master_match_statistics",
    f"""
    WITH {_FULL_SQL},
    matched("table", join_type, rows_matched) AS (
      SELECT 'customer', 'dimension', count(c_custkey) FROM full_master
      UNION ALL SELECT 'shipments', 'snapshot', count(l_orderkey) FROM full_master
      UNION ALL SELECT 'lineitem', 'bridge', count(k) FROM full_master)
    SELECT "table", join_type, n AS rows_total, rows_matched, n - rows_matched AS rows_unmatched,
           round(rows_matched / n, 6) AS match_rate
    FROM matched, (SELECT count(*) AS n FROM fact)
    """,
)
def master_match_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(master.match_statistics(_full_master(spark, folder)))


@query(
    "master_column_coverage",
    f"""
    WITH {_FULL_SQL}
    SELECT "column", round(100.0 * filled / n, 6) AS coverage FROM (
      SELECT 'customer_name' AS "column", count(c_name) AS filled, count(*) AS n FROM full_master
      UNION ALL SELECT 'c_mktsegment', count(c_mktsegment), count(*) FROM full_master
      UNION ALL SELECT 'l_shipdate', count(l_shipdate), count(*) FROM full_master
      UNION ALL SELECT 'last_line_price', count(l_extendedprice), count(*) FROM full_master
      UNION ALL SELECT 'l_partkey', count(l_partkey), count(*) FROM full_master
      UNION ALL SELECT 'part_count', count(*), count(*) FROM full_master
      UNION ALL SELECT 'top_part', count(top_part), count(*) FROM full_master
      UNION ALL SELECT 'part_list', count(part_list), count(*) FROM full_master)
    """,
)
def master_column_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(master.column_coverage(_full_master(spark, folder)))


@query(
    "master_integrity",
    """
    SELECT count(*) AS rows_before, count(*) AS rows_after, count(DISTINCT o_orderkey) AS distinct_keys,
           count(*) FILTER (WHERE o_orderkey IS NULL) AS null_keys FROM orders
    """,
)
def master_integrity(spark: SparkSession, folder: str) -> DataFrame:
    fact = _orders_with_gaps(spark, folder)
    return master.integrity_counts(fact, _full_master(spark, folder).result, "o_orderkey")


_VERSIONS_SQL = """
    versions AS (
      SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, 'Version_1' AS dataset_version FROM orders
      WHERE o_orderdate < TIMESTAMP '1999-01-01'
      UNION ALL BY NAME
      SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, 'Version_2' AS dataset_version FROM orders
      WHERE o_orderdate >= TIMESTAMP '1998-01-01')
"""


def order_versions(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Two overlapping deliveries of orders with different columns."""
    orders = table(spark, folder, "orders")
    shared = ["o_orderkey", "o_custkey", "o_totalprice"]
    return {
        "Version_1": orders.filter("o_orderdate < '1999-01-01'").select(*shared, "o_orderpriority"),
        "Version_2": orders.filter("o_orderdate >= '1998-01-01'").select(*shared, "o_orderstatus"),
    }


@query(
    "master_union_versions",
    f"""
    WITH {_VERSIONS_SQL}
    SELECT o_orderkey, o_custkey, o_totalprice, coalesce(o_orderpriority, '-') AS o_orderpriority,
           coalesce(o_orderstatus, '-') AS o_orderstatus, dataset_version FROM versions
    """,
)
def master_union_versions(spark: SparkSession, folder: str) -> DataFrame:
    union = master.union_versions(order_versions(spark, folder))
    return union.fillna("-", subset=["o_orderpriority", "o_orderstatus"])


@query(
    "master_by_version",
    f"""
    WITH {_VERSIONS_SQL},
    names AS (
      SELECT 'Version_1' AS dataset_version, c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0
      UNION ALL SELECT 'Version_2', c_custkey, 'v2 ' || c_name FROM customer)
    SELECT v.dataset_version, o_orderkey, coalesce(c_name, '-') AS c_name
    FROM versions v LEFT JOIN names n ON v.dataset_version = n.dataset_version AND o_custkey = c_custkey
    """,
)
def master_by_version(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    names = master.union_versions(
        {
            "Version_1": without_keys(customer, "c_custkey", "c_custkey % 2 <> 0"),
            "Version_2": customer.withColumn("c_name", F.concat(F.lit("v2 "), "c_name")),
        }
    )
    fact = master.union_versions(order_versions(spark, folder))
    spec = DimensionJoin("customer", "o_custkey", "c_custkey")
    state = master.build_master(fact, {"customer": names}, [spec], scope=("dataset_version",))
    return state.result.select("dataset_version", "o_orderkey", F.coalesce("c_name", F.lit("-")).alias("c_name"))


@query(
    "master_summary",
    f"""
    WITH {_VERSIONS_SQL}
    SELECT count(DISTINCT dataset_version) AS versions, count(*) AS rows, 1 AS joins, 2 AS columns_created,
           1 AS tables_skipped FROM versions
    """,
)
def master_summary(spark: SparkSession, folder: str) -> DataFrame:
    fact = master.union_versions(order_versions(spark, folder))
    specs = [DimensionJoin("customer", "o_custkey", "c_custkey", output=("c_name", "c_mktsegment")), DimensionJoin("absent", "x", "y")]
    state = master.build_master(fact, {"customer": table(spark, folder, "customer")}, specs)
    return master.master_summary(state.result, state)


@query(
    "join_keep_matching",
    "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def join_keep_matching(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return master.keep_matching(table(spark, folder, "orders"), keys, ["o_custkey"]).select("o_orderkey")


@query(
    "join_keep_missing",
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
)
def join_keep_missing(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return master.keep_missing(table(spark, folder, "customer"), keys, ["c_custkey"]).select("c_custkey")


@query(
    "missing_references",
    """
    SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size % 4 <> 1)
    """,
)
def missing_references(spark: SparkSession, folder: str) -> DataFrame:
    part = without_keys(table(spark, folder, "part"), "p_partkey", "p_size % 4 = 1")
    return profile.missing_keys(table(spark, folder, "lineitem"), "l_partkey", part, "p_partkey")


# --------------------------------------------------------------- feature store


@query(
    "features_numbers_and_times",
    """
    WITH raw AS (
      SELECT event_id, CASE WHEN event_id % 8 = 0 THEN 'n/a' ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END AS listed,
             CASE WHEN event_id % 9 = 0 THEN 'soon' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS seen,
             CASE WHEN event_id % 10 = 0 THEN '?' ELSE CAST(user_id AS VARCHAR) END AS amount FROM events)
    SELECT event_id, coalesce(strftime(make_timestamp(try_cast(listed AS BIGINT) * 1000), '%Y-%m-%d %H:%M:%S'), '-') AS listed,
           coalesce(strftime(try_cast(seen AS TIMESTAMP), '%Y-%m-%d %H:%M:%S'), '-') AS seen,
           coalesce(try_cast(amount AS DOUBLE), -1) AS amount FROM raw
    """,
)
def features_numbers_and_times(spark: SparkSession, folder: str) -> DataFrame:
    raw = _raw_events(spark, folder)
    config = FeatureConfig(epoch_ms=("listed",), datetimes=("seen",), numbers=("amount",))
    typed = features.to_datetimes(features.to_numbers(raw, config.numbers), config)
    form = "yyyy-MM-dd HH:mm:ss"
    return typed.select(
        "event_id",
        F.coalesce(F.date_format("listed", form), F.lit("-")).alias("listed"),
        F.coalesce(F.date_format("seen", form), F.lit("-")).alias("seen"),
        F.coalesce("amount", F.lit(-1.0)).alias("amount"),
    )


def _raw_events(spark: SparkSession, folder: str) -> DataFrame:
    key, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    return table(spark, folder, "events").select(
        "event_id",
        F.when(key % 8 == 0, "n/a").otherwise(F.unix_millis(ts).cast("string")).alias("listed"),
        F.when(key % 9 == 0, "soon").otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).alias("seen"),
        F.when(key % 10 == 0, "?").otherwise(F.col("user_id").cast("string")).alias("amount"),
    )


@query(
    "features_time_losses",
    """
    SELECT 'listed' AS "column", count(*) FILTER (WHERE event_id % 8 = 0) AS lost FROM events
    UNION ALL SELECT 'seen', count(*) FILTER (WHERE event_id % 9 = 0) FROM events
    """,
)
def features_time_losses(spark: SparkSession, folder: str) -> DataFrame:
    config = FeatureConfig(epoch_ms=("listed",), datetimes=("seen",))
    return features.datetime_losses(_raw_events(spark, folder), config)


def _gappy_orders(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(key % 6 != 0, F.col("o_totalprice")).alias("price"),
        F.when(key % 7 != 0, F.col("o_custkey")).alias("customer"),
        F.when(key % 5 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(key % 4 != 0, F.col("o_orderpriority")).alias("priority"),
        F.when(key % 3 != 0, F.concat(F.lit("note "), key.cast("string"))).alias("note"),
        F.when(key % 9 != 0, F.col("o_totalprice")).alias("kept_price"),
        F.when(key % 8 != 0, key % 4).alias("level"),
    )


_GAPPY_ORDERS = """
    gappy AS (
      SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice END AS price,
             CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS customer,
             CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS status,
             CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS priority,
             CASE WHEN o_orderkey % 3 <> 0 THEN 'note ' || o_orderkey END AS note,
             CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END AS kept_price,
             CASE WHEN o_orderkey % 8 <> 0 THEN o_orderkey % 4 END AS level FROM orders)
"""
FILLS = FeatureConfig(
    fill_strategies={"kept_price": "leave", "priority": "constant", "level": "constant", "o_orderkey": "leave"},
    fill_constants={"priority": "UNKNOWN"},
)


@query(
    "features_fill_missing",
    f"""
    WITH {_GAPPY_ORDERS}
    SELECT o_orderkey,
           round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM gappy)), 4) AS price,
           round(coalesce(customer::DOUBLE, (SELECT quantile_cont(customer::DOUBLE, 0.5) FROM gappy)), 4) AS customer,
           coalesce(status, (SELECT status FROM gappy WHERE status IS NOT NULL GROUP BY status
                             ORDER BY count(*) DESC, status LIMIT 1)) AS status,
           coalesce(priority, 'UNKNOWN') AS priority, coalesce(note, '-') AS note, coalesce(kept_price, -2) AS kept_price,
           coalesce(level::DOUBLE, -1) AS level
    FROM gappy
    """,
)
def features_fill_missing(spark: SparkSession, folder: str) -> DataFrame:
    filled = features.fill_missing(_gappy_orders(spark, folder), FILLS)
    # note has too many values for a mode and keeps its gaps, kept_price is left alone
    return rounded(filled.fillna({"note": "-", "kept_price": -2.0}), 4).withColumn("level", F.col("level").cast("double"))


@query(
    "features_modes",
    f"""
    WITH {_GAPPY_ORDERS},
    long AS (SELECT 'status' AS "column", status AS v FROM gappy UNION ALL SELECT 'priority', priority FROM gappy
             UNION ALL SELECT 'level', CAST(level AS VARCHAR) FROM gappy)
    SELECT "column", v AS mode FROM long WHERE v IS NOT NULL GROUP BY "column", v
    QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, v) = 1
    """,
)
def features_modes(spark: SparkSession, folder: str) -> DataFrame:
    found = features.modes(_gappy_orders(spark, folder), ["status", "priority", "level", "note"], 100)
    return found.select("column", F.coalesce("text", F.col("whole").cast("string")).alias("mode"))


# two-digit ties, more than a hundred numbers with a clear mode, times with few and with many values
@query(
    "features_modes_of_numbers",
    """
    WITH gappy AS (
      SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN CASE o_orderkey % 4 WHEN 0 THEN 9.0 WHEN 1 THEN 9.0 ELSE 10.0 END END::DOUBLE AS tied,
             CASE WHEN o_orderkey % 7 <> 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN 12345678901234567 ELSE o_orderkey END END AS number,
             CASE WHEN o_orderkey % 6 <> 0 THEN date_trunc('year', o_orderdate) END AS year,
             CASE WHEN o_orderkey % 6 <> 1 THEN o_orderdate END AS day FROM orders)
    SELECT o_orderkey,
           coalesce(tied, (SELECT tied FROM gappy WHERE tied IS NOT NULL GROUP BY tied ORDER BY count(*) DESC, tied LIMIT 1)) AS tied,
           coalesce(number, (SELECT number FROM gappy WHERE number IS NOT NULL GROUP BY number ORDER BY count(*) DESC, number LIMIT 1)) AS number,
           strftime(coalesce(year, (SELECT year FROM gappy WHERE year IS NOT NULL GROUP BY year ORDER BY count(*) DESC, year LIMIT 1)), '%Y-%m-%d') AS year,
           coalesce(strftime(day, '%Y-%m-%d'), '-') AS day
    FROM gappy
    """,
)
def features_modes_of_numbers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    gappy = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(key % 5 != 0, F.when(key % 4 < 2, 9.0).otherwise(10.0)).alias("tied"),
        F.when(key % 7 != 0, F.when(key % 3 == 0, F.lit(12345678901234567)).otherwise(key)).alias("number"),
        F.when(key % 6 != 0, F.date_trunc("year", "o_orderdate")).alias("year"),
        F.when(key % 6 != 1, F.col("o_orderdate")).alias("day"),
    )
    config = FeatureConfig(fill_strategies={"o_orderkey": "leave"}, numeric_strategy="mode")
    filled = features.fill_missing(gappy, config)
    # day has too many values for a mode and keeps its gaps
    texts = {c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit("-")) for c in ("year", "day")}
    return filled.withColumns(texts)


@query(
    "features_booleans_and_categories",
    """
    WITH raw AS (
      SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN ' YES ' WHEN 1 THEN 'true' WHEN 2 THEN '0' WHEN 3 THEN 'no'
                     WHEN 4 THEN '1.0' END AS remote, doc_id % 3 AS sponsored,
             CASE doc_id % 5 WHEN 0 THEN 'None' WHEN 1 THEN ' NaN ' WHEN 2 THEN '' ELSE '  ' || upper(source) || ' ' END AS kind,
             '  -' || lang || ' / ' || source || '!' AS token FROM documents)
    SELECT doc_id, CASE WHEN remote IS NULL THEN 'null' WHEN lower(trim(remote)) IN ('1', '1.0', 'true', 't', 'yes', 'y')
           THEN 'true' ELSE 'false' END AS remote, sponsored = 1 AS sponsored,
           coalesce(nullif(nullif(nullif(trim(lower(kind)), 'none'), 'nan'), ''), '-') AS kind,
           upper(trim(regexp_replace(token, '[^0-9A-Za-z]+', '_', 'g'), '_')) AS token FROM raw
    """,
)
def features_booleans_and_categories(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("doc_id")
    remote = F.when(key % 6 == 0, " YES ").when(key % 6 == 1, "true").when(key % 6 == 2, "0")
    remote = remote.when(key % 6 == 3, "no").when(key % 6 == 4, "1.0")
    kind = F.when(key % 5 == 0, "None").when(key % 5 == 1, " NaN ").when(key % 5 == 2, "")
    raw = table(spark, folder, "documents").select(
        "doc_id",
        remote.alias("remote"),
        (key % 3).alias("sponsored"),
        kind.otherwise(F.concat(F.lit("  "), F.upper("source"), F.lit(" "))).alias("kind"),
        X.category_token(F.concat(F.lit("  -"), "lang", F.lit(" / "), "source", F.lit("!"))).alias("token"),
    )
    config = FeatureConfig(booleans=("remote", "sponsored"), categories=("kind",))
    done = features.clean_categories(features.to_booleans(raw, config), config)
    return done.withColumns(
        {
            "remote": F.coalesce(F.col("remote").cast("string"), F.lit("null")),
            "kind": F.coalesce("kind", F.lit("-")),
        }
    )


# compatibility forms written into the texts, and what NFKC makes of them
@query(
    "features_normal_texts",
    r"""
    WITH raw AS (SELECT doc_id, 'ﬁrst ' || chr(160) || text || ' Ⅳ' AS text FROM documents)
    SELECT doc_id, md5(trim(regexp_replace(nfc_normalize(
      replace(replace(replace(replace(replace(text, 'ﬁ', 'fi'), 'Ⅳ', 'IV'), '…', '...'), '™', 'TM'), chr(160), ' ')),
      '[\s\x0b\x1c-\x1f\x85\p{Z}]+', ' ', 'g'))) AS digest FROM raw
    """,
)
def features_normal_texts(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "documents").select(
        "doc_id", F.concat(F.lit("ﬁrst  "), "text", F.lit(" Ⅳ")).alias("text")
    )
    config = FeatureConfig(texts=("text",))
    return features.clean_texts(raw, config).select("doc_id", F.md5("text").alias("digest"))


@query(
    "features_lists",
    """
    WITH raw AS (
      SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN ' ;, '
        ELSE source || ' | ' || lang || '/' || upper(source) || ';a-' || (doc_id % 4) || ',,' || lang END AS tags FROM documents),
    items AS (SELECT doc_id, unnest(regexp_split_to_array(tags, '[|,;/]')) AS item FROM raw),
    tokens AS (SELECT DISTINCT doc_id, upper(trim(regexp_replace(item, '[^0-9A-Za-z]+', '_', 'g'), '_')) AS t FROM items)
    SELECT raw.doc_id, coalesce(string_agg(t, '|' ORDER BY t) FILTER (WHERE t <> ''), '-') AS tags,
           count(t) FILTER (WHERE t <> '') AS tag_count
    FROM raw LEFT JOIN tokens USING (doc_id) GROUP BY raw.doc_id
    """,
)
def features_lists(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("doc_id")
    tags = F.concat(
        "source", F.lit(" | "), "lang", F.lit("/"), F.upper("source"), F.lit(";a-"), (key % 4).cast("string"), F.lit(",,"), "lang"
    )
    raw = table(spark, folder, "documents").select(
        "doc_id", F.when(key % 7 == 1, " ;, ").when(key % 7 != 0, tags).alias("tags")
    )
    config = FeatureConfig(lists=("tags",), list_counts={"tag_count": "tags"})
    done = features.standardise_lists(raw, config)
    return done.withColumns(features.list_counts(done, config)).fillna("-", subset=["tags"])


@query(
    "features_presence_flags",
    f"""
    WITH {_GAPPY_ORDERS}
    SELECT o_orderkey, note IS NOT NULL AS has_note, status IS NOT NULL AND priority IS NOT NULL AS fully_described,
           coalesce(price, kept_price) IS NOT NULL AS salary_available FROM gappy
    """,
)
def features_presence_flags(spark: SparkSession, folder: str) -> DataFrame:
    orders = _gappy_orders(spark, folder)
    config = FeatureConfig(
        salary_columns=("price", "kept_price", "absent"),
        presence_flags={"has_note": ("note",), "fully_described": ("status", "priority")},
    )
    flags = features.presence_flags(orders, config)
    return orders.select("o_orderkey", *[c.alias(n) for n, c in flags.items()])


@query("features_drop_duplicates", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def features_drop_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_nationkey", "c_mktsegment")
    return features.drop_duplicates(customer, FeatureConfig())


ORDER_FEATURES = FeatureConfig(
    identifiers=("o_orderkey",),
    categories=("status", "priority"),
    texts=("note",),
    fill_strategies={"kept_price": "leave", "priority": "constant", "level": "leave"},
    salary_columns=("price", "kept_price"),
    presence_flags={"has_note": ("note",)},
)


@query(
    "features_summary",
    f"""
    WITH {_GAPPY_ORDERS},
    nulls AS (
      SELECT count(*) AS n, count(*) - count(price) AS price, count(*) - count(customer) AS customer,
             count(*) - count(status) AS status, count(*) - count(priority) AS priority, count(*) - count(note) AS note,
             count(*) - count(kept_price) AS kept_price, count(*) - count(level) AS level FROM gappy),
    store AS (
      SELECT DISTINCT coalesce(price, (SELECT quantile_cont(price, 0.5) FROM gappy)) AS price,
             coalesce(customer::DOUBLE, (SELECT quantile_cont(customer::DOUBLE, 0.5) FROM gappy)) AS customer,
             coalesce(status, (SELECT status FROM gappy WHERE status IS NOT NULL GROUP BY status ORDER BY count(*) DESC, status LIMIT 1)) AS status,
             coalesce(priority, 'UNKNOWN') AS priority, note, kept_price, level, note IS NOT NULL AS has_note,
             coalesce(price, kept_price) IS NOT NULL AS salary_available FROM gappy)
    SELECT n AS rows_before, (SELECT count(*) FROM store) AS rows_after,
           price + customer + status + priority + note + kept_price + level AS nulls_before,
           (SELECT 3 * count(*) - count(note) - count(kept_price) - count(level) FROM store) AS nulls_after,
           price + customer + status + priority AS cells_filled, n - (SELECT count(*) FROM store) AS rows_removed,
           8 AS columns_before, 9 AS columns_after FROM nulls
    """,
)
def features_summary(spark: SparkSession, folder: str) -> DataFrame:
    build = features.build_features(_gappy_orders(spark, folder), ORDER_FEATURES)
    return features.feature_summary(build).drop("schema_hash")


@query(
    "features_store",
    f"""
    WITH {_GAPPY_ORDERS}
    SELECT DISTINCT round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM gappy)), 4) AS price,
           round(coalesce(customer::DOUBLE, (SELECT quantile_cont(customer::DOUBLE, 0.5) FROM gappy)), 4) AS customer,
           lower(coalesce(status, (SELECT status FROM gappy WHERE status IS NOT NULL GROUP BY status
                                   ORDER BY count(*) DESC, status LIMIT 1))) AS status,
           lower(coalesce(priority, 'UNKNOWN')) AS priority, coalesce(note, '-') AS note,
           coalesce(round(kept_price, 4), -2) AS kept_price, coalesce(level, -1) AS level, note IS NOT NULL AS has_note,
           coalesce(price, kept_price) IS NOT NULL AS salary_available
    FROM gappy
    """,
)
def features_store(spark: SparkSession, folder: str) -> DataFrame:
    store = features.build_features(_gappy_orders(spark, folder), ORDER_FEATURES).result
    return rounded(store, 4).fillna({"note": "-", "kept_price": -2.0, "level": -1})


# ----------------------------------------------------- fingerprints and changes


@query(
    "fingerprint_survives_repartition",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS rows, 'unchanged' AS status FROM lineitem GROUP BY ALL
    """,
)
def fingerprint_survives_repartition(spark: SparkSession, folder: str) -> DataFrame:
    by = ["l_returnflag", "l_linestatus"]
    lines = table(spark, folder, "lineitem")
    stored = fingerprint.content_fingerprint(lines, by)
    current = fingerprint.content_fingerprint(lines.repartition(13, "l_partkey"), by)
    return fingerprint.changes(current, stored, by).join(stored.select(*by, "rows"), by).select(*by, "rows", "status")


@query(
    "changed_partitions",
    """
    WITH then_rows AS (SELECT CAST(month(o_orderdate) AS INT) AS part, o_orderkey, o_totalprice FROM orders WHERE month(o_orderdate) <= 10),
    now_rows AS (SELECT CAST(month(o_orderdate) AS INT) AS part, o_orderkey,
                 CASE WHEN month(o_orderdate) = 4 AND o_orderkey % 100 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
          FROM orders WHERE month(o_orderdate) >= 3),
    differing AS (
      SELECT part FROM (SELECT * FROM then_rows EXCEPT ALL SELECT * FROM now_rows)
      UNION SELECT part FROM (SELECT * FROM now_rows EXCEPT ALL SELECT * FROM then_rows))
    SELECT part, CASE WHEN part NOT IN (SELECT part FROM then_rows) THEN 'new'
                      WHEN part NOT IN (SELECT part FROM now_rows) THEN 'gone'
                      WHEN part IN (SELECT part FROM differing) THEN 'changed' ELSE 'unchanged' END AS status
    FROM (SELECT part FROM then_rows UNION SELECT part FROM now_rows)
    """,
)
def changed_partitions(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(F.month("o_orderdate").alias("part"), "o_orderkey", "o_totalprice")
    raised = F.when((F.col("part") == 4) & (F.col("o_orderkey") % 100 == 1), F.col("o_totalprice") + 1)
    now = orders.filter("part >= 3").withColumn("o_totalprice", raised.otherwise(F.col("o_totalprice")))
    before = fingerprint.content_fingerprint(orders.filter("part <= 10"), ["part"])
    return fingerprint.changes(fingerprint.content_fingerprint(now, ["part"]), before, ["part"])
