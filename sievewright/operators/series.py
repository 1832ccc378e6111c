"""Time series of counts. Rows are counted per period before anything else, so
windows and spines only see one row per period (and category).

Series of days, weeks and months fit one task. Series of minutes or seconds can
be long: :func:`counts_per_step` and the functions on its result cut them into
blocks of consecutive places. A window reaches into its neighbours by copies of
their boundary rows, so no task gets more than a block and its halo.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievewright.functions import columns as X

PERIODS = {"day": "interval 1 day", "week": "interval 7 days", "month": "interval 1 month"}


def period_start(time: Column, period: str) -> Column:
    return F.to_date(time) if period == "day" else F.to_date(F.date_trunc(period, time))


def period_label(start: Column, period: str) -> Column:
    """The day that names a period: itself, the closing Sunday, the month's end."""
    if period == "week":
        return F.date_add(start, 6)
    return F.last_day(start) if period == "month" else start


def _dense(counts: DataFrame, period: str, by: Sequence[str] = ()) -> DataFrame:
    """Fill the gaps between first and last period with zeros."""
    limits = counts.agg(F.min("start").alias("lo"), F.max("start").alias("hi"))
    days = limits.select(F.explode(F.sequence("lo", "hi", F.expr(PERIODS[period]))).alias("start"))
    if by:
        # the spine rows are attached to each category as one bounded array
        calendar = days.agg(F.array_sort(F.collect_list("start"))).scalar()
        spine = counts.select(*by).distinct().withColumn("start", F.explode(calendar))
    else:
        spine = days
    joined = spine.join(counts, ["start", *by], "left")
    return joined.select("start", *by, F.coalesce("rows", F.lit(0)).alias("rows"))


def counts_per_period(df: DataFrame, time: str, period: str = "day") -> DataFrame:
    """``(date, rows)`` for every period from the first to the last."""
    present = df.filter(F.col(time).isNotNull())
    counts = present.groupBy(period_start(F.col(time), period).alias("start")).agg(F.count("*").alias("rows"))
    return _dense(counts, period).select(period_label(F.col("start"), period).alias("date"), "rows")


def rolling_mean(series: DataFrame, size: int = 7) -> DataFrame:
    """Mean of the last ``size`` periods; null until there are that many."""
    window = Window.orderBy("date").rowsBetween(-(size - 1), 0)
    mean = F.when(F.count("rows").over(window) == size, F.avg("rows").over(window))
    return series.withColumn("rolling_mean", mean)


def weekday_counts(df: DataFrame, time: str) -> DataFrame:
    """Rows per day of the week, Monday first, days without rows included."""
    counts = (
        df.filter(F.col(time).isNotNull()).groupBy(F.weekday(time).alias("weekday")).agg(F.count("*").alias("rows"))
    )
    # The names of the days.
    names = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
    by_day = [F.coalesce(F.max(F.when(F.col("weekday") == i, F.col("rows"))), F.lit(0)) for i in range(7)]
    days = [
        F.struct(F.lit(i).alias("weekday"), F.lit(n).alias("day_name"), F.col(f"_{i}").alias("rows"))
        for i, n in enumerate(names)
    ]
    wide = counts.agg(*[c.alias(f"_{i}") for i, c in enumerate(by_day)])
    return wide.select(F.inline(F.array(*days)))


def calendar_parts(time: Column) -> dict[str, Column]:
    """Year, quarter, month and day of the week (Monday is 0)."""
    return {
        "year": F.year(time),
        "quarter": F.quarter(time),
        "month": F.month(time),
        "weekday": F.weekday(time),
    }


def top_categories(df: DataFrame, category: str, k: int) -> DataFrame:
    counts = df.filter(F.col(category).isNotNull()).groupBy(category).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), category).limit(k).select(category)


def category_counts(df: DataFrame, time: str, category: str, period: str, k: int | None = None) -> DataFrame:
    """``(start, category, rows)`` for the ``k`` largest categories, gaps as zeros.

    Rows are counted per period and category first; only counts meet the list of
    top categories.
    """
    present = df.filter(F.col(time).isNotNull() & F.col(category).isNotNull())
    counts = present.groupBy(period_start(F.col(time), period).alias("start"), category).agg(F.count("*").alias("rows"))
    if k is not None:
        counts = counts.join(top_categories(df, category, k), category, "left_semi")
    return _dense(counts, period, [category])


def category_shares(df: DataFrame, time: str, category: str, period: str, k: int) -> DataFrame:
    """Share of each of the ``k`` largest categories in their period."""
    counts = category_counts(df, time, category, period, k)
    total = F.sum("rows").over(Window.partitionBy("start"))
    return counts.withColumn("share", F.try_divide(F.col("rows"), total))


def growth(df: DataFrame, time: str, category: str, k: int) -> DataFrame:
    """Rows before and after the midpoint of time for the ``k`` largest categories,
    and the growth in percent (null if there were none before)."""
    micros = X.wall_micros(F.col(time))
    limits = df.agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    ends = [X.wall_micros(F.col(c)) for c in ("lo", "hi")]
    midpoint = limits.select((ends[0] + (ends[1] - ends[0]) / 2).alias("m")).scalar()
    halves = df.filter(F.col(category).isNotNull()).withColumn("_sw_mid", midpoint)
    counts = halves.groupBy(category).agg(
        F.count("*").alias("_sw_n"),
        F.count_if(micros < F.col("_sw_mid")).alias("first_half"),
        F.count_if(micros >= F.col("_sw_mid")).alias("second_half"),
    )
    top = counts.orderBy(F.desc("_sw_n"), category).limit(k)
    change = F.try_divide((F.col("second_half") - F.col("first_half")) * F.lit(100.0), F.col("first_half"))
    return top.select(category, "first_half", "second_half", change.alias("growth_percent"))


def volatility(df: DataFrame, time: str, category: str, k: int, period: str = "week") -> DataFrame:
    """Deviation over mean of the period counts, for the ``k`` largest categories."""
    counts = category_counts(df, time, category, period, k)
    return counts.groupBy(category).agg(
        F.try_divide(F.stddev_samp("rows"), F.avg("rows")).alias("coefficient_of_variation")
    )


def forecast_target(df: DataFrame, time: str, category: str | None = None) -> DataFrame:
    """Daily counts: dense in total, or per category for the days that have rows."""
    if category is None:
        return counts_per_period(df, time)
    present = df.filter(F.col(time).isNotNull() & F.col(category).isNotNull())
    return present.groupBy(F.to_date(time).alias("date"), category).agg(F.count("*").alias("rows"))


def decompose(series: DataFrame, period: int = 7) -> DataFrame:
    """Additive trend, seasonal and residual parts of a dense ``(date, rows)`` series.

    Trend: centred mean over one (odd) period, null at the ends. Seasonal: mean of
    the detrended values per position, shifted to add up to zero.
    """
    if period % 2 == 0:
        raise ValueError("the period must be odd")
    half = period // 2
    around = Window.orderBy("date").rowsBetween(-half, half)
    placed = series.withColumns(
        {
            "trend": F.when(F.count("rows").over(around) == period, F.avg("rows").over(around)),
            "position": (F.row_number().over(Window.orderBy("date")) - 1) % period,
        }
    )
    detrended = F.col("rows") - F.col("trend")
    by_position = placed.groupBy("position").agg(F.avg(detrended).alias("raw"))
    seasonal = by_position.withColumn("seasonal", F.col("raw") - F.avg("raw").over(Window.partitionBy()))
    joined = placed.join(seasonal.select("position", "seasonal"), "position")
    return joined.select(
        "date", "rows", "trend", "seasonal", (F.col("rows") - F.col("trend") - F.col("seasonal")).alias("residual")
    )


def autocorrelation(series: DataFrame, lags: int) -> DataFrame:
    """``(lag, acf)`` for lags 0 to ``lags`` of a dense ``(date, rows)`` series."""
    mean = series.agg(F.avg("rows")).scalar()
    centred = series.withColumn("x", F.col("rows") - mean)
    numbered = centred.select(F.row_number().over(Window.orderBy("date")).alias("i"), "x")
    shifted = numbered.select(F.explode(F.sequence(F.lit(0), F.lit(lags))).alias("lag"), "i", F.col("x").alias("y"))
    pairs = shifted.withColumn("i", F.col("i") + F.col("lag")).join(numbered, "i")
    products = pairs.groupBy("lag").agg(F.sum(F.col("x") * F.col("y")).alias("p"))
    # lag 0 is the sum of squares
    square = F.first(F.when(F.col("lag") == 0, F.col("p")), ignorenulls=True).over(Window.partitionBy())
    return products.select("lag", F.try_divide(F.col("p"), square).alias("acf"))


# ------------------------------------------------------------------ long series

#: Places of a long series that one window partition holds.
BLOCK = 1 << 16


def counts_per_step(df: DataFrame, time: str, seconds: int = 60) -> DataFrame:
    """``(place, at, rows)`` for every step from the first to the last, ``place`` from 0. Runs a job for both ends.

    The steps are a distributed range, not an array in one row. Without times
    there are no steps.
    """
    step = F.floor(X.wall_micros(F.col(time)) / F.lit(1_000_000 * seconds)).cast("bigint")
    counts = df.filter(F.col(time).isNotNull()).groupBy(step.alias("_sw_step")).agg(F.count("*").alias("rows"))
    ends = df.filter(F.col(time).isNotNull()).agg(F.min(step), F.max(step)).first()
    first, last = ends if ends[0] is not None else (0, -1)
    steps = df.sparkSession.range(first, last + 1).withColumnRenamed("id", "_sw_step")
    joined = steps.join(counts, "_sw_step", "left")
    place = (F.col("_sw_step") - F.lit(first)).alias("place")
    return joined.select(place, F.timestamp_seconds(F.col("_sw_step") * seconds).alias("at"), F.coalesce("rows", F.lit(0)).alias("rows"))


def with_halo(series: DataFrame, before: int, after: int, block: int = BLOCK) -> DataFrame:
    """The rows under ``_sw_block``, the blocks whose windows they are in, and ``_sw_own``, whether it is their block.

    ``before`` and ``after`` say how many places a window reaches. A row goes to
    every block with a place that reaches it, so the copies are a window's width
    per block.
    """
    first = F.floor((F.col("place") - after) / F.lit(block)).cast("bigint")
    last = F.floor((F.col("place") + before) / F.lit(block)).cast("bigint")
    own = F.floor(F.col("place") / F.lit(block)).cast("bigint")
    dealt = series.withColumn("_sw_block", F.explode(F.sequence(first, last)))
    return dealt.withColumn("_sw_own", F.col("_sw_block") == own)


def _own(df: DataFrame) -> DataFrame:
    return df.filter("_sw_own").drop("_sw_own", "_sw_block")


def rolling_mean_of_steps(series: DataFrame, size: int, block: int = BLOCK) -> DataFrame:
    """:func:`rolling_mean` of a long dense series ``(place, at, rows)``."""
    window = Window.partitionBy("_sw_block").orderBy("place").rowsBetween(-(size - 1), 0)
    mean = F.when(F.count("rows").over(window) == size, F.avg("rows").over(window))
    return _own(with_halo(series, size - 1, 0, block).withColumn("rolling_mean", mean))


def decompose_steps(series: DataFrame, period: int, block: int = BLOCK) -> DataFrame:
    """:func:`decompose` of a long dense series ``(place, at, rows)``."""
    if period % 2 == 0:
        raise ValueError("the period must be odd")
    half = period // 2
    around = Window.partitionBy("_sw_block").orderBy("place").rowsBetween(-half, half)
    trend = F.when(F.count("rows").over(around) == period, F.avg("rows").over(around))
    placed = _own(with_halo(series, half, half, block).withColumn("trend", trend))
    placed = placed.withColumn("position", F.col("place") % period)
    # sums of whole numbers and of the trend, one row per position
    by_position = placed.groupBy("position").agg(F.avg(F.col("rows") - F.col("trend")).alias("raw"))
    seasonal = by_position.withColumn("seasonal", F.col("raw") - by_position.agg(F.avg("raw")).scalar())
    joined = placed.join(seasonal.select("position", "seasonal"), "position")
    residual = F.col("rows") - F.col("trend") - F.col("seasonal")
    return joined.select("place", "at", "rows", "trend", "seasonal", residual.alias("residual"))


def autocorrelation_of_steps(series: DataFrame, lags: int, block: int = BLOCK) -> DataFrame:
    """:func:`autocorrelation` of a long dense series ``(place, at, rows)``: products per block, added up."""
    mean = series.agg(F.avg("rows")).scalar()
    centred = series.select("place", (F.col("rows") - mean).alias("x"))
    earlier = Window.partitionBy("_sw_block").orderBy("place")
    dealt = with_halo(centred, lags, 0, block)
    # the halo holds the last rows before the block, so a lag that is null lies before the series
    products = [(F.col("x") * F.lag("x", i).over(earlier)).alias(f"_{i}") for i in range(lags + 1)]
    sums = _own(dealt.select("_sw_own", "_sw_block", *products)).agg(*[F.sum(f"_{i}").alias(f"_{i}") for i in range(lags + 1)])
    entries = [F.struct(F.lit(i).alias("lag"), F.try_divide(F.col(f"_{i}"), F.col("_0")).alias("acf")) for i in range(lags + 1)]
    return sums.select(F.inline(F.array(*entries)))
