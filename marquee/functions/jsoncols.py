"""Lenient parsing of JSON-list text columns (S-1 ... S-5).

The catalogue stores genres, keywords, cast and crew as text holding a list of
objects.  Parsing is a column expression (``from_json`` + higher-order
functions), so it runs per row inside whole-stage code generation and never
raises under ANSI mode: blank, null, non-list and malformed text all give an
empty list.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _is_list_text(c: Column) -> Column:
    # from_json on '{}' with an array schema yields [null]; only text that
    # starts with '[' is treated as a list.
    return F.ltrim(c).startswith("[")


def json_names(c) -> Column:
    """``array<string>``: each object's ``name`` ('' when absent); scalar items as text.

    Single-quoted (Python-literal style) lists are accepted; null items are
    dropped; anything that is not a list gives ``[]``.
    """
    c = _col(c)
    items = F.from_json(c, "array<string>", {"allowSingleQuotes": "true", "mode": "PERMISSIVE"})
    names = F.transform(
        items,
        lambda e: F.when(e.startswith("{"), F.coalesce(F.get_json_object(e, "$.name"), F.lit("")))
        .otherwise(e))
    names = F.filter(names, lambda e: e.isNotNull())
    return F.when(c.isNotNull() & _is_list_text(c), F.coalesce(names, F.array().cast("array<string>"))) \
        .otherwise(F.array().cast("array<string>"))


_CREW_SCHEMA = "array<struct<job:string,name:string>>"


def first_by_job(c, job: str = "Director") -> Column:
    """Name of the first list entry whose ``job`` equals ``job``; '' when none (S-2)."""
    c = _col(c)
    crew = F.from_json(c, _CREW_SCHEMA, {"allowSingleQuotes": "true"})
    hit = F.try_element_at(F.filter(crew, lambda m: m["job"] == F.lit(job)), F.lit(1))
    return F.when(c.isNotNull() & _is_list_text(c), F.coalesce(hit["name"], F.lit(""))).otherwise(F.lit(""))


def first_n_names(c, n: int = 5) -> Column:
    """Names of the first ``n`` entries, '' for an entry without a name (S-3)."""
    c = _col(c)
    cast = F.from_json(c, "array<struct<name:string>>", {"allowSingleQuotes": "true"})
    names = F.transform(F.slice(cast, 1, n), lambda m: F.coalesce(m["name"], F.lit("")))
    return F.when(c.isNotNull() & _is_list_text(c), F.coalesce(names, F.array().cast("array<string>"))) \
        .otherwise(F.array().cast("array<string>"))


def split_trim(c, sep: str = ",") -> Column:
    """Comma text to a trimmed list; null gives ``[]`` (S-4)."""
    c = _col(c)
    return F.when(c.isNull(), F.array().cast("array<string>")) \
        .otherwise(F.transform(F.split(c, sep), lambda g: F.trim(g)))


def join_list(c, sep: str = ", ") -> Column:
    """List to text joined by ``', '`` (S-5)."""
    return F.array_join(_col(c), sep)
