"""Column expressions shared by the operators.

Everything here is built from native Spark functions except Unicode NFKC,
which Spark lacks; see :func:`nfkc`.

Spark's ``trim`` and ``\\s`` know ASCII blanks only, while the data may hold any
Unicode white space, so the patterns below switch Java's ``(?U)`` mode on.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

BLANKS = r"(?U)[\s\x1c-\x1f]+"
EDGE_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
WHOLE_NUMBER = r"^[+-]?\d{1,19}$"
NON_ASCII = r"[^\x00-\x7f]"

# Texts that stand for "no value" once trimmed (case-sensitive).
NULL_TOKENS = ("nan", "None", "<NA>", "")
# The category cleanup compares after lower-casing.
CATEGORY_NULL_TOKENS = ("nan", "none", "")
# Texts read as true, compared lower-case and trimmed.
TRUTHY = ("1", "1.0", "true", "t", "yes", "y")

INTEGRAL = ("tinyint", "smallint", "int", "bigint")
FRACTIONAL = ("float", "double")


def is_numeric(dtype: str) -> bool:
    return dtype in INTEGRAL or dtype in FRACTIONAL or dtype.startswith("decimal")


# ---------------------------------------------------------------- white space


def utrim(c: Column) -> Column:
    return F.regexp_replace(c, EDGE_BLANKS, "")


def squash(c: Column) -> Column:
    """Collapse every run of white space to one space."""
    return F.regexp_replace(c, BLANKS, " ")


def tidy(c: Column) -> Column:
    """Trim and collapse; after the collapse only plain spaces are left to trim."""
    return F.trim(squash(c))


def drop_tokens(c: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    return F.when(~c.isin(*tokens), c)


def clean_string(
    c: Column,
    *,
    trim: bool = True,
    collapse: bool = True,
    lower: bool = False,
    empty_to_null: bool = True,
) -> Column:
    if trim and collapse:
        c = tidy(c)
    elif trim:
        c = utrim(c)
    elif collapse:
        c = squash(c)
    if lower:
        c = F.lower(c)
    if empty_to_null:
        present = drop_tokens(c)
        c = present if trim else F.when(c.rlike(r"(?U)[^\s\x1c-\x1f]"), present)
    return c


# --------------------------------------------------------------------- numbers


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def to_double(c: Column, dtype: str) -> Column:
    """Number or null; never raises. NaN counts as null."""
    if dtype in FRACTIONAL:
        return nan_to_null(c.cast("double"))
    if is_numeric(dtype) or dtype == "boolean":
        return c.cast("double")
    if dtype == "string":
        return F.when(c.rlike(NUMBER), F.trim(c).try_cast("double"))
    return F.lit(None).cast("double")


def to_long(c: Column, dtype: str) -> Column:
    """Whole number or null: ``'101'``, ``101`` and ``101.0`` agree, 1.5 is null."""
    if dtype in INTEGRAL or dtype == "boolean":
        return c.cast("bigint")
    number = to_double(c, dtype)
    whole = F.when((number == F.floor(number)) & (F.abs(number) < 2.0**63), number.try_cast("bigint"))
    if dtype == "string":
        # keep all digits of long identifiers: no detour over double for plain integers
        text = utrim(c)
        return F.when(text.rlike(WHOLE_NUMBER), text.try_cast("bigint")).otherwise(whole)
    return whole


def cast_to(c: Column, dtype: str, target: str) -> Column:
    """Conversion to a canonical type; values that do not fit become null."""
    if target == "bigint":
        return to_long(c, dtype)
    if target == "double":
        return to_double(c, dtype)
    return c.try_cast(target)


def log1p_or_null(c: Column) -> Column:
    """``log1p`` with negative values treated as missing."""
    return F.when(c >= 0, F.log1p(c))


# ------------------------------------------------------------- flags and dates


def truthy(c: Column, dtype: str, texts: Sequence[str] = TRUTHY) -> Column:
    if dtype == "boolean":
        return c
    if is_numeric(dtype):
        return c == 1
    return F.when(c.isNotNull(), F.lower(utrim(c)).isin(*texts))


def epoch_ms_to_timestamp(c: Column, dtype: str) -> Column:
    # 2**53 / 1000 keeps the value inside Spark's timestamp range
    ms = to_double(c, dtype)
    return F.when(F.abs(ms) < 9.0e14, F.timestamp_millis(F.floor(ms).cast("bigint")))


def text_to_timestamp(c: Column) -> Column:
    return c.try_cast("timestamp")


def wall_micros(time: Column) -> Column:
    """Microseconds since 1970 on the clock the time shows, in any session zone.

    Times without a zone have no daylight saving, so they must not be converted
    through the session's.
    """
    days = F.datediff(F.to_date(time), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = (days * 24 + F.hour(time)) * 3600 + F.minute(time) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("bigint")


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour periods between two times, floored (not calendar days)."""
    micros = wall_micros(end) - wall_micros(start)
    return F.floor(micros / F.lit(86_400_000_000)).cast("bigint")


# ------------------------------------------------------------------------ text


# Values of an Arrow batch that are Python objects at a time: a batch may hold 10,000 long texts.
_SLICE = 32


def _by_slices(values: pa.Array, change: Callable) -> pa.Array:
    done = []
    for at in range(0, len(values), _SLICE):
        part = values.slice(at, _SLICE).to_pylist()
        done.append(pa.array([None if v is None else change(v) for v in part], values.type))
    return pa.concat_arrays(done) if done else values


def _normal(text: str) -> str:
    return unicodedata.normalize("NFKC", text)


@F.arrow_udf(StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    return _by_slices(texts, _normal)


@F.arrow_udf(ArrayType(StringType()))
def _nfkc_items(lists: pa.Array) -> pa.Array:
    return _by_slices(lists, lambda items: [None if t is None else _normal(t) for t in items])


def nfkc(c: Column) -> Column:
    """Unicode NFKC. Plain ASCII is already normal, so only the other values
    are sent to the Python worker; the rest cross as nulls."""
    return F.coalesce(_nfkc(F.when(c.rlike(NON_ASCII), c)), c)


def nfkc_items(c: Column) -> Column:
    foreign = F.exists(c, lambda t: t.rlike(NON_ASCII))
    return F.coalesce(_nfkc_items(F.when(foreign, c)), c)


def normal_text(c: Column) -> Column:
    """NFKC, white space collapsed and trimmed, empty text to null."""
    text = tidy(nfkc(c))
    return F.when(text != "", text)


def category(c: Column) -> Column:
    """Lower-case, trimmed category with the usual null spellings removed."""
    return drop_tokens(utrim(F.lower(c)), CATEGORY_NULL_TOKENS)


def _token(text: Column) -> Column:
    token = F.upper(F.btrim(F.regexp_replace(text, r"[^0-9A-Za-z]+", "_"), F.lit("_")))
    return F.when(token != "", token)


def category_token(c: Column) -> Column:
    """``' Full-time / remote'`` becomes ``FULL_TIME_REMOTE``."""
    return _token(nfkc(c))


LIST_SEPARATORS = r"[|,;/]"


def list_tokens(c: Column, dtype: str) -> Column:
    """Sorted, distinct tokens of a list value (array, or delimited text)."""
    items = c if dtype.startswith("array") else F.split(utrim(c), LIST_SEPARATORS)
    tokens = F.array_compact(F.transform(nfkc_items(items), _token))
    unique = F.array_sort(F.array_distinct(tokens))
    return F.when(F.size(unique) > 0, unique)


def join_list(c: Column, delimiter: str = "|") -> Column:
    return F.array_join(c, delimiter)


def list_length(c: Column, delimiter: str = "|") -> Column:
    """Number of non-empty parts of a delimited text; null counts as 0."""
    parts = F.filter(F.split(c, f"[{delimiter}]"), lambda p: p != "")
    return F.coalesce(F.size(parts), F.lit(0)).cast("bigint")


def parse_list(c: Column, dtype: str, delimiter: str = "|") -> Column:
    """Array of trimmed, non-empty parts from an array or a delimited text."""
    if dtype.startswith("array"):
        return F.coalesce(c, F.array().cast(dtype))
    parts = F.filter(F.transform(F.split(c, f"[{delimiter}]"), utrim), lambda p: p != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def group_key(parts: Sequence[Column]) -> Column:
    """SHA-256 over the normalised parts; the same posting gets the same key."""
    tidied = [tidy(F.lower(F.coalesce(p.cast("string"), F.lit("unknown")))) for p in parts]
    return F.sha2(F.concat_ws("||", *tidied), 256)


def word_count(c: Column) -> Column:
    text = tidy(c)
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " "))).cast("bigint")


def ratio(part: Column, whole: Column, scale: float = 100.0) -> Column:
    """``scale * part / whole``; null instead of an error when whole is 0."""
    return F.try_divide(part * F.lit(scale), whole.cast("double"))
