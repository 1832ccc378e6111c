"""One row per key.

Spark rows have no order, so "first" and "last" always follow an explicit
``order_by``. Filtering ``row_number() = 1`` lets Spark keep one row per key in
every task before the shuffle (WindowGroupLimit), so a key that holds a third of
the table sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_RANK = "_sw_rank"


def first_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    window = Window.partitionBy(*key).orderBy(*order_by)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def last_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    return first_per_key(df, key, [F.col(c).desc_nulls_first() for c in order_by])


def only_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once.

    Each task sends at most two rows of a key, enough to tell; the count over
    the same partitioning needs no further shuffle.
    """
    window = Window.partitionBy(*key)
    two = df.withColumn(_RANK, F.row_number().over(window.orderBy(*key))).filter(F.col(_RANK) <= 2)
    counted = two.withColumn("_sw_n", F.count(F.lit(1)).over(window))
    return counted.filter("_sw_n = 1").drop(_RANK, "_sw_n")
