"""Time series on events and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions import columns as X
from sievewright.operators import series
from sievewright.queries.registry import query, rounded, table


def _text_dates(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in names})


# events moved to the next day leave days without any, so that the gaps have to be filled
def _rare_events(spark: SparkSession, folder: str) -> DataFrame:
    late = F.when(F.dayofmonth("ts") % 4 == 2, F.col("ts") + F.expr("INTERVAL 1 DAY"))
    return table(spark, folder, "events").withColumn("ts", late.otherwise(F.col("ts")))


# the same for orders and months
def _late_orders(spark: SparkSession, folder: str) -> DataFrame:
    late = F.when(F.month("o_orderdate") % 3 == 0, F.col("o_orderdate") + F.expr("INTERVAL 31 DAYS"))
    return table(spark, folder, "orders").withColumn("o_orderdate", late.otherwise(F.col("o_orderdate")))


_LATE_ORDERS = """
    late AS (SELECT * REPLACE (CASE WHEN month(o_orderdate) % 3 = 0 THEN o_orderdate + INTERVAL 31 DAY ELSE o_orderdate END AS o_orderdate) FROM orders)
"""


_DAILY = """
    rare AS (SELECT * REPLACE (CASE WHEN day(ts) % 4 = 2 THEN ts + INTERVAL 1 DAY ELSE ts END AS ts) FROM events),
    spine AS (SELECT unnest(generate_series((SELECT min(ts)::DATE FROM rare), (SELECT max(ts)::DATE FROM rare), INTERVAL 1 DAY))::DATE AS d),
    daily AS (SELECT d, count(r.ts) AS rows FROM spine LEFT JOIN rare r ON r.ts::DATE = d GROUP BY d)
"""


@query("series_daily_counts", f"WITH {_DAILY} SELECT strftime(d, '%Y-%m-%d') AS date, rows FROM daily")
def series_daily_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _text_dates(series.counts_per_period(_rare_events(spark, folder), "ts"), "date")


@query(
    "series_weekly_counts",
    f"""
    WITH {_LATE_ORDERS}, w AS (SELECT date_trunc('week', o_orderdate)::DATE AS w, count(*) AS n FROM late GROUP BY 1),
    spine AS (SELECT unnest(generate_series((SELECT min(w) FROM w), (SELECT max(w) FROM w), INTERVAL 7 DAY))::DATE AS s)
    SELECT strftime(s + 6, '%Y-%m-%d') AS date, coalesce(n, 0) AS rows FROM spine LEFT JOIN w ON w.w = s
    """,
)
def series_weekly_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _text_dates(series.counts_per_period(_late_orders(spark, folder), "o_orderdate", "week"), "date")


@query(
    "series_monthly_counts",
    f"""
    WITH {_LATE_ORDERS}, m AS (SELECT date_trunc('month', o_orderdate)::DATE AS m, count(*) AS n FROM late GROUP BY 1),
    spine AS (SELECT unnest(generate_series((SELECT min(m) FROM m), (SELECT max(m) FROM m), INTERVAL 1 MONTH))::DATE AS s)
    SELECT strftime(last_day(s), '%Y-%m-%d') AS date, coalesce(n, 0) AS rows FROM spine LEFT JOIN m ON m.m = s
    """,
)
def series_monthly_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _text_dates(series.counts_per_period(_late_orders(spark, folder), "o_orderdate", "month"), "date")


@query(
    "series_rolling_mean",
    f"""
    WITH {_DAILY}
    SELECT strftime(d, '%Y-%m-%d') AS date, rows,
           coalesce(CASE WHEN count(*) OVER w = 7 THEN round(avg(rows) OVER w, 6) END, -1) AS rolling_mean
    FROM daily WINDOW w AS (ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
    """,
)
def series_rolling_mean(spark: SparkSession, folder: str) -> DataFrame:
    daily = series.counts_per_period(_rare_events(spark, folder), "ts")
    return _text_dates(rounded(series.rolling_mean(daily)).fillna(-1.0, subset=["rolling_mean"]), "date")


@query(
    "series_weekday_counts",
    """
    SELECT (isodow(ts) - 1)::INT AS weekday, dayname(ts) AS day_name, count(*) AS rows FROM events GROUP BY ALL
    """,
)
def series_weekday_counts(spark: SparkSession, folder: str) -> DataFrame:
    return series.weekday_counts(table(spark, folder, "events"), "ts")


@query(
    "series_calendar_parts",
    """
    SELECT year(o_orderdate)::INT AS year, quarter(o_orderdate)::INT AS quarter, month(o_orderdate)::INT AS month,
           (isodow(o_orderdate) - 1)::INT AS weekday, count(*) AS rows FROM orders GROUP BY ALL
    """,
)
def series_calendar_parts(spark: SparkSession, folder: str) -> DataFrame:
    parts = series.calendar_parts(F.col("o_orderdate"))
    orders = table(spark, folder, "orders").select(*[c.alias(n) for n, c in parts.items()])
    return orders.groupBy(*parts).agg(F.count("*").alias("rows"))


@query(
    "series_elapsed_days",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           floor((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000)::BIGINT AS days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def series_elapsed_days(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    joined = table(spark, folder, "lineitem").join(orders, "l_orderkey")
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        X.elapsed_days(F.col("o_orderdate"), F.col("l_shipdate")).alias("days"),
    )


@query(
    "series_elapsed_days_of_events",
    """
    SELECT days, count(*) AS rows FROM (
      SELECT floor((epoch_us(e.ts) - epoch_us(f.first_ts)) / 86400000000)::BIGINT AS days
      FROM events e JOIN (SELECT user_id, max(ts) AS first_ts FROM events GROUP BY user_id) f USING (user_id))
    GROUP BY days
    """,
)
def series_elapsed_days_of_events(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    marks = events.groupBy("user_id").agg(F.max("ts").alias("mark"))
    days = events.join(marks, "user_id").select(X.elapsed_days(F.col("mark"), F.col("ts")).alias("days"))
    return days.groupBy("days").agg(F.count("*").alias("rows"))


_TOP3 = """
    top AS (SELECT event_type FROM rare GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 3)
"""


@query(
    "series_top_category_counts",
    f"""
    WITH {_DAILY}, {_TOP3},
    c AS (SELECT ts::DATE AS d, event_type, count(*) AS n FROM rare WHERE event_type IN (SELECT event_type FROM top) GROUP BY ALL),
    s AS (SELECT unnest(generate_series((SELECT min(d) FROM c), (SELECT max(d) FROM c), INTERVAL 1 DAY))::DATE AS d)
    SELECT strftime(s.d, '%Y-%m-%d') AS start, top.event_type, coalesce(n, 0) AS rows
    FROM s CROSS JOIN top LEFT JOIN c ON c.d = s.d AND c.event_type = top.event_type
    """,
)
def series_top_category_counts(spark: SparkSession, folder: str) -> DataFrame:
    events = _rare_events(spark, folder)
    return _text_dates(series.category_counts(events, "ts", "event_type", "day", 3), "start")


@query(
    "series_category_shares",
    """
    SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS start, o_orderpriority, count(*) AS rows,
           round(count(*) / any_value(t.n), 6) AS share
    FROM orders JOIN (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1) t
      ON t.m = date_trunc('month', o_orderdate)
    GROUP BY ALL
    UNION ALL
    SELECT strftime(m, '%Y-%m-%d'), p, 0, 0 FROM (SELECT DISTINCT date_trunc('month', o_orderdate) AS m FROM orders),
      (SELECT DISTINCT o_orderpriority AS p FROM orders)
    WHERE (m, p) NOT IN (SELECT (date_trunc('month', o_orderdate), o_orderpriority) FROM orders)
    """,
)
def series_category_shares(spark: SparkSession, folder: str) -> DataFrame:
    shares = series.category_shares(table(spark, folder, "orders"), "o_orderdate", "o_orderpriority", "month", 5)
    return _text_dates(rounded(shares), "start")


@query(
    "series_growth",
    """
    WITH m AS (SELECT (epoch_us(min(o_orderdate)) + epoch_us(max(o_orderdate))) / 2.0::DOUBLE AS mid FROM orders),
    c AS (SELECT o_orderpriority, count(*) AS n, count(*) FILTER (WHERE epoch_us(o_orderdate) < mid) AS first_half,
                 count(*) FILTER (WHERE epoch_us(o_orderdate) >= mid) AS second_half FROM orders, m GROUP BY o_orderpriority)
    SELECT o_orderpriority, first_half, second_half, round(100.0 * (second_half - first_half) / nullif(first_half, 0), 6) AS growth_percent
    FROM c ORDER BY n DESC, o_orderpriority LIMIT 4
    """,
)
def series_growth(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(series.growth(table(spark, folder, "orders"), "o_orderdate", "o_orderpriority", 4))


@query(
    "series_volatility",
    """
    WITH top AS (SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 4),
    c AS (SELECT date_trunc('week', o_orderdate)::DATE AS w, o_orderpriority, count(*) AS n FROM orders
          WHERE o_orderpriority IN (SELECT o_orderpriority FROM top) GROUP BY ALL),
    s AS (SELECT unnest(generate_series((SELECT min(w) FROM c), (SELECT max(w) FROM c), INTERVAL 7 DAY))::DATE AS w),
    dense AS (SELECT s.w, top.o_orderpriority, coalesce(n, 0) AS n FROM s CROSS JOIN top
              LEFT JOIN c ON c.w = s.w AND c.o_orderpriority = top.o_orderpriority)
    SELECT o_orderpriority, round(stddev_samp(n) / avg(n), 6) AS coefficient_of_variation FROM dense GROUP BY 1
    """,
)
def series_volatility(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(series.volatility(table(spark, folder, "orders"), "o_orderdate", "o_orderpriority", 4))


@query(
    "series_forecast_target_by_category",
    "SELECT strftime(ts, '%Y-%m-%d') AS date, event_type, count(*) AS rows FROM events GROUP BY ALL",
)
def series_forecast_target_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return _text_dates(series.forecast_target(table(spark, folder, "events"), "ts", "event_type"), "date")


@query(
    "series_forecast_target",
    """
    WITH s AS (SELECT unnest(generate_series((SELECT min(ts)::DATE FROM events), (SELECT max(ts)::DATE FROM events), INTERVAL 1 DAY))::DATE AS d)
    SELECT strftime(d, '%Y-%m-%d') AS date, count(ts) AS rows FROM s LEFT JOIN events ON ts::DATE = d GROUP BY d
    """,
)
def series_forecast_target(spark: SparkSession, folder: str) -> DataFrame:
    return _text_dates(series.forecast_target(table(spark, folder, "events"), "ts"), "date")


@query(
    "series_decomposition",
    f"""
    WITH {_DAILY},
    t AS (SELECT d, rows, (row_number() OVER (ORDER BY d) - 1) % 7 AS pos,
                 CASE WHEN count(*) OVER w = 7 THEN avg(rows) OVER w END AS trend
          FROM daily WINDOW w AS (ORDER BY d ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
    p AS (SELECT pos, avg(rows - trend) AS raw FROM t GROUP BY pos),
    s AS (SELECT pos, raw - (SELECT avg(raw) FROM p) AS seasonal FROM p)
    SELECT strftime(d, '%Y-%m-%d') AS date, rows, round(coalesce(trend, -1), 6) AS trend, round(seasonal, 6) AS seasonal,
           round(coalesce(rows - trend - seasonal, -999), 6) AS residual
    FROM t JOIN s USING (pos)
    """,
)
def series_decomposition(spark: SparkSession, folder: str) -> DataFrame:
    daily = series.counts_per_period(_rare_events(spark, folder), "ts")
    parts = series.decompose(daily).fillna({"trend": -1.0, "residual": -999.0})
    return _text_dates(rounded(parts), "date")


@query(
    "series_autocorrelation",
    """
    WITH s AS (SELECT unnest(generate_series((SELECT min(o_orderdate)::DATE FROM orders), (SELECT max(o_orderdate)::DATE FROM orders), INTERVAL 1 DAY))::DATE AS d),
    daily AS (SELECT d, count(o_orderdate) AS n FROM s LEFT JOIN orders ON o_orderdate::DATE = d GROUP BY d),
    x AS (SELECT row_number() OVER (ORDER BY d) AS i, n - (SELECT avg(n) FROM daily) AS x FROM daily)
    SELECT lag::INT AS lag, round(sum(a.x * b.x) / (SELECT sum(x * x) FROM x), 6) AS acf
    FROM range(31) AS l(lag) JOIN x a ON true JOIN x b ON b.i = a.i + lag GROUP BY lag
    """,
)
def series_autocorrelation(spark: SparkSession, folder: str) -> DataFrame:
    daily = series.counts_per_period(table(spark, folder, "orders"), "o_orderdate")
    return rounded(series.autocorrelation(daily, 30))


_MINUTES = """
    steps AS (SELECT floor(epoch_us(ts) / 60000000)::BIGINT AS m, count(*) AS n FROM events GROUP BY 1),
    spine AS (SELECT unnest(range((SELECT min(m) FROM steps), (SELECT max(m) + 1 FROM steps))) AS m),
    minutes AS (SELECT row_number() OVER (ORDER BY m) - 1 AS place, coalesce(n, 0) AS rows FROM spine LEFT JOIN steps USING (m))
"""


def _minutes(spark: SparkSession, folder: str) -> DataFrame:
    return series.counts_per_step(table(spark, folder, "events"), "ts", 60)


@query(
    "series_rolling_mean_by_minute",
    f"""
    WITH {_MINUTES}
    SELECT place, rows, coalesce(CASE WHEN count(*) OVER w = 90 THEN round(avg(rows) OVER w, 6) END, -1) AS rolling_mean
    FROM minutes WINDOW w AS (ORDER BY place ROWS BETWEEN 89 PRECEDING AND CURRENT ROW)
    """,
)
def series_rolling_mean_by_minute(spark: SparkSession, folder: str) -> DataFrame:
    rolled = series.rolling_mean_of_steps(_minutes(spark, folder), 90, block=4096)
    return rounded(rolled.drop("at")).fillna(-1.0, subset=["rolling_mean"])


@query(
    "series_decomposition_by_minute",
    f"""
    WITH {_MINUTES},
    t AS (SELECT place, rows, place % 61 AS pos, CASE WHEN count(*) OVER w = 61 THEN avg(rows) OVER w END AS trend
          FROM minutes WINDOW w AS (ORDER BY place ROWS BETWEEN 30 PRECEDING AND 30 FOLLOWING)),
    p AS (SELECT pos, avg(rows - trend) AS raw FROM t GROUP BY pos),
    s AS (SELECT pos, raw - (SELECT avg(raw) FROM p) AS seasonal FROM p)
    SELECT place, rows, round(coalesce(trend, -1), 6) AS trend, round(seasonal, 6) AS seasonal,
           round(coalesce(rows - trend - seasonal, -999), 6) AS residual FROM t JOIN s USING (pos)
    """,
)
def series_decomposition_by_minute(spark: SparkSession, folder: str) -> DataFrame:
    parts = series.decompose_steps(_minutes(spark, folder), 61, block=4096).drop("at")
    return rounded(parts.fillna({"trend": -1.0, "residual": -999.0}))


@query(
    "series_autocorrelation_by_minute",
    f"""
    WITH {_MINUTES},
    x AS (SELECT place, rows - (SELECT avg(rows) FROM minutes) AS x FROM minutes)
    SELECT lag::INT AS lag, round(sum(a.x * b.x) / (SELECT sum(x * x) FROM x), 6) AS acf
    FROM range(31) AS l(lag) JOIN x a ON true JOIN x b ON b.place = a.place + lag GROUP BY lag
    """,
)
def series_autocorrelation_by_minute(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(series.autocorrelation_of_steps(_minutes(spark, folder), 30, block=4096))
