"""Column functions against plain Python on small inputs."""

from __future__ import annotations

import hashlib
import re
import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievewright.functions import columns as X


def apply(spark, values, function, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


TEXTS = ["  a  b ", " x y\t", "a\n\nb", "", "   ", None, "nan", " None ", "<NA>", "NONE", "é ﬁ", "\x1cz\x85"]


def test_clean_string(spark):
    def expected(v):
        if v is None:
            return None
        v = re.sub(r"\s+", " ", v.strip())
        return None if v in ("nan", "None", "<NA>", "") else v

    assert apply(spark, TEXTS, X.clean_string) == [expected(v) for v in TEXTS]


def test_clean_string_parts(spark):
    assert apply(spark, [" A  B "], lambda c: X.clean_string(c, trim=False)) == [" A B "]
    assert apply(spark, [" A  B "], lambda c: X.clean_string(c, collapse=False, lower=True)) == ["a  b"]
    assert apply(spark, ["  "], lambda c: X.clean_string(c, trim=False)) == [None]
    assert apply(spark, [" nan"], lambda c: X.clean_string(c, empty_to_null=False)) == ["nan"]


@pytest.mark.parametrize(
    ("text", "number", "whole"),
    [
        ("101", 101.0, 101),
        ("101.0", 101.0, 101),
        (" 12 ", 12.0, 12),
        ("1.5", 1.5, None),
        ("1e3", 1000.0, 1000),
        ("-7", -7.0, -7),
        ("abc", None, None),
        ("", None, None),
        ("1d", None, None),
        ("9007199254740993", 9007199254740992.0, 9007199254740993),
        (None, None, None),
    ],
)
def test_numbers(spark, text, number, whole):
    assert apply(spark, [text], lambda c: X.to_double(c, "string")) == [number]
    assert apply(spark, [text], lambda c: X.to_long(c, "string")) == [whole]


def test_numbers_from_doubles(spark):
    values = [1.0, 1.5, float("nan"), None]
    assert apply(spark, values, lambda c: X.to_long(c, "double"), "double") == [1, None, None, None]
    assert apply(spark, values, lambda c: X.to_double(c, "double"), "double") == [1.0, 1.5, None, None]


def test_truthy(spark):
    texts = ["1", "TRUE", " yes ", "y", "no", "0", "", None]
    assert apply(spark, texts, lambda c: X.truthy(c, "string")) == [True, True, True, True, False, False, False, None]
    assert apply(spark, [1.0, 0.0, 2.0, None], lambda c: X.truthy(c, "double"), "double") == [True, False, False, None]


def test_normal_text(spark):
    def expected(v):
        if v is None:
            return None
        v = re.sub(r"\s+", " ", unicodedata.normalize("NFKC", v).replace(" ", " ")).strip()
        return v or None

    texts = [*TEXTS, "ℌ½™", "é", "plain"]
    assert apply(spark, texts, X.normal_text) == [expected(v) for v in texts]


@pytest.mark.parametrize("lists", [False, True])
def test_nfkc_holds_few_texts_of_a_batch_as_objects(lists):
    texts = [None if i % 7 == 0 else f"{i} " + "ﬁé" * 2000 for i in range(2000)]
    values = [t if t is None or not lists else [t, None] for t in texts]
    batch = pa.array(values, pa.list_(pa.string()) if lists else pa.string())
    tracemalloc.start()
    done = (X._nfkc_items if lists else X._nfkc).func(batch)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 2_000_000 and done.type == batch.type
    normal = [t and unicodedata.normalize("NFKC", t) for t in texts]
    assert done.to_pylist() == [t if t is None or not lists else [t, None] for t in normal]


def test_category_and_token(spark):
    assert apply(spark, [" Full-Time ", "NaN", "none", "", "<NA>", None], X.category) == [
        "full-time",
        None,
        None,
        None,
        "<na>",
        None,
    ]
    assert apply(spark, [" Full-time / remote!", "--", None, "ﬁne"], X.category_token) == [
        "FULL_TIME_REMOTE",
        None,
        None,
        "FINE",
    ]


def test_lists(spark):
    texts = ["b| a ;B,c/ｄ", " ,;", "", None]
    got = apply(spark, texts, lambda c: X.join_list(X.list_tokens(c, "string")))
    assert got == ["A|B|C|D", None, None, None]
    arrays = [["b b", "a", None, "B-b"], [], None, ["x|y"]]
    got = apply(spark, arrays, lambda c: X.join_list(X.list_tokens(c, "array<string>")), "array<string>")
    assert got == ["A|B_B", None, None, "X_Y"]
    assert apply(spark, ["A|B||C", "", None], X.list_length) == [3, 0, 0]
    assert apply(spark, ["a | b||", None], lambda c: X.parse_list(c, "string")) == [["a", "b"], []]


def test_group_key(spark):
    df = spark.createDataFrame([(" Senior  Dev", None, "NY "), ("senior dev", "unknown", "ny")], "a string, b string, c string")
    keys = [r[0] for r in df.select(X.group_key([F.col(c) for c in "abc"])).collect()]
    assert keys == [hashlib.sha256(b"senior dev||unknown||ny").hexdigest()] * 2


def test_times(spark):
    df = spark.createDataFrame([(1704067200000.0, "1704067200000", "x")], "a double, b string, c string")
    got = df.select(
        *[F.date_format(X.epoch_ms_to_timestamp(F.col(c), t), "yyyy-MM-dd HH:mm") for c, t in (("a", "double"), ("b", "string"), ("c", "string"))]
    ).first()
    assert tuple(got) == ("2024-01-01 00:00", "2024-01-01 00:00", None)


def test_elapsed_days_are_floored(spark):
    df = spark.sql("select timestamp'2024-01-02 12:00' a, timestamp'2024-01-01 13:00' b, timestamp'2024-01-04 11:00' c")
    got = df.select(X.elapsed_days(F.col("a"), F.col("b")), X.elapsed_days(F.col("a"), F.col("c"))).first()
    assert tuple(got) == (-1, 1)


def test_word_count(spark):
    assert apply(spark, ["a  b c", "", " ", None], X.word_count) == [3, 0, 0, None]
