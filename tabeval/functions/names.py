"""Cleaning of column, table and folder names, and of byte-size texts."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabeval.functions.fixed import BYTE_UNITS


def _joined_words(name: Column, separator: str) -> Column:
    """Drop the separators and start every word with a capital."""
    words = F.split(name, separator, -1)
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), "")


def clean_column_name(name: Column) -> Column:
    for separator in ("-", "_", r"(?U)\s+"):
        name = _joined_words(name, separator)
    return F.regexp_replace(name, r"\p{Punct}", "")


def clean_table_name(name: Column) -> Column:
    for separator in (" ", "_", "-"):
        name = _joined_words(name, separator)
    return name


def _clean_text(name: str, separators: list[str | None]) -> str:
    for separator in separators:
        name = "".join(word[:1].upper() + word[1:] for word in name.split(separator))
    return name


def clean_column_text(name: str) -> str:
    """The schema-side twin of :func:`clean_column_name`."""
    return re.sub(f"[{re.escape(string.punctuation)}]", "", _clean_text(name, ["-", "_", None]))


def clean_table_text(name: str) -> str:
    return _clean_text(name, [" ", "_", "-"])


def folder_of(ref: str) -> str:
    """The folder that holds the files of a dataset."""
    return ref.replace("/", "_")


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Clean every column name; a name that is already taken gets a number behind it."""
    taken: dict[str, int] = {}
    names = []
    for column in df.columns:
        clean = clean_column_text(column)
        key = clean.lower()
        taken[key] = taken.get(key, 0) + 1
        names.append(clean if taken[key] == 1 else f"{clean}{taken[key]}")
    return df.toDF(*names)


def parse_size(size: Column) -> Column:
    """Bytes of a text such as ``12MB``: its first digits times its first upper-case unit."""
    digits = F.regexp_extract(size, "([0-9]+)", 1)
    unit = F.regexp_extract(size, "([A-Z]+)", 1)
    factor = F.lit(None).cast("bigint")
    for name, bytes_per_unit in BYTE_UNITS.items():
        factor = F.when(unit == name, F.lit(bytes_per_unit).cast("bigint")).otherwise(factor)
    return digits.try_cast("bigint") * factor
