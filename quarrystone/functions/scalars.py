"""Scalar expressions shared by the operators; all but :func:`folded` are built-in functions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrystone import contracts

SPACES, TOKEN = r"[\p{Cc}\p{Z}]+", r"[\p{L}\p{N}_]+"


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def blank_to_null(c: Column | str) -> Column:
    """Null where nothing but spaces is there; other values keep their padding."""
    return F.when(F.trim(text(c)) != "", text(c))


def parsed_date(c: Column | str, *more: str) -> Column:
    """The date written as month/day/year or year/month/day (or by one of ``more`` patterns), else null."""
    value = F.trim(text(c))
    return F.coalesce(*(F.try_to_timestamp(value, F.lit(p)).cast("date") for p in ("M/d/yyyy", "yyyy/M/d", *more)))


def content_hash(columns: list[Column]) -> Column:
    """SHA-256 over the values, each marked null or prefixed by its length, so that no two rows share an encoding."""
    def encoded(c: Column) -> Column:
        return F.when(c.isNull(), F.lit("<NULL>")).otherwise(F.concat(F.lit("V"), F.length(text(c)).cast("string"), F.lit(":"), text(c)))

    return F.sha2(F.concat_ws("|", *map(encoded, columns)) if columns else F.lit(""), 256)


def outcome(c: Column | str) -> Column:
    """The category of a reported event type: one of the mapped words, missing for blanks, else unrecognized."""
    mapping = F.create_map(*map(F.lit, chain.from_iterable(contracts.OUTCOMES.items())))
    return F.coalesce(F.try_element_at(mapping, F.upper(F.trim(F.coalesce(text(c), F.lit(""))))), F.lit(contracts.UNRECOGNIZED))


def product_code(c: Column | str) -> Column:
    return F.nullif(F.upper(F.trim(text(c))), F.lit(""))


def role_of(filename: Column | str) -> Column:
    """change, add or base by the end of a file name's stem."""
    stem = F.regexp_replace(F.lower(text(filename)), r"(^.*/)|(\.[^./]*$)", "")
    return F.when(stem.endswith("change"), "change").when(stem.endswith("add"), "add").otherwise("base")


def priority(role: Column | str) -> Column:
    mapping = F.create_map(*map(F.lit, chain.from_iterable(contracts.ROLES.items())))
    return F.element_at(mapping, text(role))


def split_of(received: Column | str) -> Column:
    """train, validation or test by the date received; null without one."""
    day = F.col(received) if isinstance(received, str) else received
    return F.when(day <= F.lit(contracts.TRAIN_UNTIL).cast("date"), "train").when(day <= F.lit(contracts.VALIDATION_UNTIL).cast("date"), "validation").when(day.isNotNull(), "test")


def month_of(day: Column | str) -> Column:
    return F.trunc(day, "MM")


def collapsed(c: Column | str) -> Column:
    """Control characters and separators become single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text(c), SPACES, " "))


def _mapped(values: pa.Array, change) -> pa.Array:  # noqa: ANN001
    return pa.array([None if x is None else change(x) for x in values.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def _composed(values: pa.Array) -> pa.Array:
    return _mapped(values, lambda x: unicodedata.normalize("NFC", x))


@F.arrow_udf(T.StringType())
def _folded(values: pa.Array) -> pa.Array:
    return _mapped(values, str.casefold)


def composed(c: Column | str) -> Column:
    """Unicode normal form C. Plain ASCII never leaves the JVM's answer, though Spark may still evaluate the function."""
    return F.when(text(c).rlike(r"[^\x00-\x7F]"), _composed(text(c))).otherwise(text(c))


def clean(c: Column | str) -> Column:
    """Narrative cleaning: normal form C, then control characters and separators collapsed."""
    return collapsed(composed(c))


def folded(c: Column | str) -> Column:
    """Case-folded with white space collapsed: the form in which texts are compared."""
    return F.when(text(c).rlike(r"[^\x00-\x7F]"), collapsed(_folded(text(c)))).otherwise(collapsed(F.lower(text(c))))


def lowered(c: Column | str) -> Column:
    """As :func:`folded` but with plain lower-casing, which other SQL engines share."""
    return collapsed(F.lower(text(c)))


def tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(text(c), F.lit(TOKEN), 0)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, also where ``use`` names it inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def neighbours(words: Column, n: int) -> Column:
    """The runs of ``n`` words, space-joined; none where there are fewer words."""
    made = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.concat_ws(" ", F.slice(words, i, n)))
    return F.when(F.size(words) >= n, made).otherwise(F.array().cast("array<string>"))


def trigrams(words: Column) -> Column:
    """Distinct word trigrams; none for fewer than three words."""
    return F.array_distinct(bound(words, lambda w: neighbours(w, 3)))


def sorted_set(c: Column) -> Column:
    """Aggregate: the distinct non-blank values in order, an empty array where there are none."""
    return F.array_sort(F.collect_set(F.when(F.trim(text(c)) != "", text(c))))
