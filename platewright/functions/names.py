"""Column and table names: cleaning, prefixing, measurement selection."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAME_LIMIT = 64

# Substitutions of the three older naming styles, applied in order (fixed values).
LEGACY_STYLES = {
    "results": [("-", "_"), ("Group", "Group_id"), (" ", ""), ("%", "percent"), ("/", "_"),
                ("[", ""), ("]", ""), ("ï»¿", ""), ("Â", "")],
    "index": [("-", "_"), ("Group", "Group_id"), (" ", ""), ("%", "percent"), ("/", "_"),
              ("[", ""), ("]", ""), ("²", ""), ("µ", "u"), ("ï»¿", ""), ("Â", "")],
    "harmony": [(" ", "_"), ("-", "_"), ("%", ""), ("[", ""), ("]", ""), ("Group", "Group_id"),
                ("µm²", "um"), ("µm", "um"), ("s", "_s")],
}

# Parts dropped from a file name to get its table name (fixed values).
FILE_NAME_NOISE = ["-", " ", ".csv", ".txt", "_trimmed", "Objects_Population"]


def clean_name(name: str, style: str = "strict") -> str:
    """A column name with only letters, digits and underscores.

    ``style`` may name one of the older styles instead.
    """
    if style == "strict":
        return re.sub(r"[^a-zA-Z0-9_]", "", name)
    for old, new in LEGACY_STYLES[style]:
        name = name.replace(old, new)
    return name


def clean_names(names: Iterable[str], style: str = "strict") -> list[str]:
    """Clean all names; two that become equal (ignoring case) are an error."""
    cleaned = [clean_name(n, style) for n in names]
    require_distinct(cleaned, "cleaned column names")
    return cleaned


def rename_clean(df: DataFrame, style: str = "strict") -> DataFrame:
    return df.toDF(*clean_names(df.columns, style))


def require_distinct(names: Iterable[str], what: str) -> None:
    seen: dict[str, str] = {}
    for name in names:
        other = seen.setdefault(name.lower(), name)
        if other is not name:
            raise ValueError(f"{what} collide: {other!r} and {name!r}")


def clean_name_col(name: Column, style: str = "strict") -> Column:
    if style == "strict":
        return F.regexp_replace(name, "[^a-zA-Z0-9_]", "")
    for old, new in LEGACY_STYLES[style]:
        name = F.replace(name, F.lit(old), F.lit(new))
    return name


def table_name_col(file_name: Column) -> Column:
    """The table name of an export file, from its file name."""
    name = file_name
    for noise in FILE_NAME_NOISE:
        name = F.replace(name, F.lit(noise), F.lit(""))
    return F.replace(name, F.lit("Index"), F.lit("Index_file"))


def prefixed(name: str, prefix: str = "Per_Field") -> str:
    return f"{prefix}_{name}"[:NAME_LIMIT]


def prefixed_names(names: Iterable[str], prefix: str = "Per_Field") -> list[str]:
    """Prefix and cap names; two that become equal after the cap are an error."""
    capped = [prefixed(n, prefix) for n in names]
    require_distinct(capped, f"names of at most {NAME_LIMIT} characters")
    return capped


def prefixed_col(name: Column, prefix: str = "Per_Field") -> Column:
    return F.substring(F.concat(F.lit(prefix + "_"), name), 1, NAME_LIMIT)


def measurement_columns(df: DataFrame, keyword: str) -> list[str]:
    """Columns whose name contains the keyword, in table order."""
    return [c for c in df.columns if keyword in c]
