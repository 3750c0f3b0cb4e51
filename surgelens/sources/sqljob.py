"""Parameterised SQL jobs.

Values are bound as named parameters (``:lookback``). Text in the older
``${name}`` style is accepted as well: such places take identifiers or numbers
only, which are checked before they are put into the text.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

_PLACE = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)\}")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")
_PLAIN = re.compile(r"-?[A-Za-z0-9_.]+\Z")


def identifier(name: str) -> str:
    if not _NAME.match(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


def fill_places(text: str, places: Mapping[str, object]) -> str:
    """Replace every ``${name}``; an unknown name or an unsafe value is an error."""

    def value(match: re.Match) -> str:
        name = match.group(1)
        if name not in places:
            raise KeyError(f"no value for ${{{name}}}")
        given = str(places[name])
        if not _PLAIN.match(given):
            raise ValueError(f"unsafe value for ${{{name}}}: {given!r}")
        return given

    return _PLACE.sub(value, text)


def run_sql(
    spark: SparkSession,
    text: str,
    args: Mapping[str, object] | None = None,
    places: Mapping[str, object] | None = None,
) -> DataFrame:
    """Bind ``args`` and ``places`` and hand the query to Catalyst."""
    text = fill_places(text, places or {}).strip().rstrip(";")
    return spark.sql(text, args=dict(args or {}))


def run_sql_file(spark: SparkSession, path: str, **bindings) -> DataFrame:
    """Run a query kept in a file, read through the file system its path belongs to."""
    return run_sql(spark, spark.read.text(path, wholetext=True).first()["value"], **bindings)
