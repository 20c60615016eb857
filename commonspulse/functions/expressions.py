"""Column expressions shared by the operators.  All of them stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commonspulse import constants as C


def scalar_text(value: Column) -> Column:
    """An extracted JSON value if it is a scalar; null for objects and arrays."""
    is_object = value.startswith("{") & F.json_object_keys(value).isNotNull()
    is_array = value.startswith("[") & F.json_array_length(value).isNotNull()
    return F.when(~(is_object | is_array), value)


def json_scalars(rows: DataFrame, text: str, **paths: str) -> DataFrame:
    """``rows`` with one column per path, holding the scalar there or null.

    The values are extracted in one step and tested in the next, so no path is
    evaluated twice.
    """
    found = rows.withColumns({name: F.get_json_object(text, path) for name, path in paths.items()})
    return found.withColumns({name: scalar_text(F.col(name)) for name in paths})


def json_array_size(text: Column, path: str) -> Column:
    """Length of the array at ``path``; null when there is none."""
    return F.json_array_length(F.get_json_object(text, path))


def as_bigint(value: Column) -> Column:
    """Cast that gives null, never an error, for text that is no integer."""
    return value.try_cast("bigint")


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (null counts as 0)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def month_of(moment: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(moment, "MM")


def month_text(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def safe_login(login: Column) -> Column:
    """File-name form of a login: lower case, runs of other characters become one dash."""
    dashed = F.regexp_replace(F.lower(login), C.UNSAFE_LOGIN_PATTERN, "-")
    return F.coalesce(F.nullif(F.btrim(dashed, F.lit("-")), F.lit("")), F.lit("unknown"))


def shard_of(name: Column) -> Column:
    """First two characters of the file name, padded with underscores."""
    return F.substring(F.concat(name, F.lit("__")), 1, 2)


def stripped(text: Column) -> Column:
    """Text without white space at its ends."""
    return F.btrim(text, F.lit(C.WHITE_SPACE))


def package_name(requirement: Column) -> Column:
    """Normalised package name at the head of a requirement; empty when there is none."""
    head = F.regexp_extract(stripped(requirement), C.PACKAGE_NAME_PATTERN, 0)
    return F.translate(F.lower(head), "_", "-")


def log_plus_one(count: Column) -> Column:
    return F.log1p(count)


def dummy(condition: Column) -> Column:
    return condition.cast("int")


def phrase_screen(name: Column, description: Column, phrases: Iterable[str] = C.SCREEN_PHRASES) -> Column:
    """True when any phrase occurs in name or description, ignoring case and nulls."""
    text = F.lower(F.concat(F.coalesce(name, F.lit("")), F.lit(" "), F.coalesce(description, F.lit(""))))
    return text.rlike("|".join(re.escape(p) for p in phrases))


def setup_eligible(language: Column, present: Column, dependencies: Column) -> Column:
    """Python, setup file present, more than one dependency.

    Unknown presence gives null for Python repositories, false for all others.
    """
    return (
        F.when(~language.eqNullSafe(F.lit("Python")), F.lit(False))
        .when(present.isNull(), F.lit(None).cast("boolean"))
        .when(~present, F.lit(False))
        .otherwise(dependencies > 1)
    )


def decode_base64_text(content: Column) -> Column:
    """Base64 text to UTF-8, with invalid bytes replaced."""
    return F.make_valid_utf8(F.unbase64(content).cast("string"))


def push_commits(kind: Column, payload: Column) -> Column:
    """Commit objects carried by a push: length of the commit list, else 0."""
    return F.when(
        kind == "PushEvent", F.coalesce(json_array_size(payload, "$.commits"), F.lit(0))
    ).otherwise(F.lit(0)).cast("bigint")


def push_size(kind: Column, size: Column, payload: Column) -> Column:
    """Commits announced by a push: its ``size`` value, else the list length, else 0."""
    return F.when(
        kind == "PushEvent",
        F.coalesce(
            as_bigint(size), json_array_size(payload, "$.commits").cast("bigint"), F.lit(0).cast("bigint")
        ),
    ).otherwise(F.lit(0).cast("bigint"))
