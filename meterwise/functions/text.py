"""Text expressions and column-name cleaning."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strip_spaces(value: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def clean_name(name: str) -> str:
    """The word runs of the accent-free lower-case name, joined by ``_``."""
    letters = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode().lower()
    return "_".join(re.findall(r"\w+", letters)).strip("_")


def normalize_column_names(df: DataFrame) -> DataFrame:
    """ASCII snake_case names; a name that repeats gets ``_2``, ``_3`` ..."""
    used: set[str] = set()
    names = []
    for original in df.columns:
        base = name = clean_name(original)
        n = 1
        while name in used:
            n += 1
            name = f"{base}_{n}"
        used.add(name)
        names.append(name)
    return df.toDF(*names)


def plain_text(value: Column) -> Column:
    """Accent-free lower-case words joined by ``_``: the name rule applied to values."""
    folded = F.regexp_replace(ascii_fold(value), r"[^A-Za-z0-9_\s]", " ")
    return F.regexp_replace(F.lower(F.regexp_replace(folded, r"\s+", "_")), "^_+|_+$", "")


def ascii_fold(value: Column) -> Column:
    """Accents removed, characters without an ASCII form dropped."""
    # Latin letters that decompose into one ASCII letter plus marks; others are dropped
    source, target = [], []
    for point in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        plain = unicodedata.normalize("NFKD", chr(point)).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            source.append(chr(point))
            target.append(plain)
    return F.regexp_replace(F.translate(value, "".join(source), "".join(target)), r"[^\x00-\x7F]", "")


def text_difference(
    source: str, target: str, empty_text: str | None = None, missing_text: str | None = None
) -> Column:
    """What the target adds to the source text.

    NULL source gives ``[source] EMPTY``; a source not in the target ``[value] NOT FOUND``.
    """
    s, t = F.col(source).cast("string"), F.coalesce(F.col(target).cast("string"), F.lit(""))
    empty = F.lit(f"[{source}] EMPTY" if empty_text is None else empty_text)
    missing = F.concat(F.lit("["), s, F.lit("] NOT FOUND")) if missing_text is None else F.lit(missing_text)
    return F.when(s.isNull(), empty).when(t.contains(s), strip_spaces(F.replace(t, s, F.lit("")))).otherwise(missing)


def contained_or_null(part: str, whole: str) -> Column:
    """True when either side is NULL or ``part`` occurs in ``whole``."""
    return F.col(part).isNull() | F.col(whole).isNull() | F.col(whole).contains(F.col(part))


def starts_with_any(value: Column, prefixes: list[str]) -> Column:
    test = F.lit(False)
    for prefix in prefixes:
        test = test | value.startswith(prefix)
    return F.coalesce(test, F.lit(False))


def contains_text(value: Column, part: str) -> Column:
    return F.coalesce(value.contains(part), F.lit(False))


def split_coordinates(df: DataFrame, column: str) -> DataFrame:
    """Add ``latitude`` and ``longitude`` from text such as ``48.85, 2.35``."""
    parts = F.split(F.col(column), ",")
    return df.withColumns(
        {
            "latitude": F.trim(F.get(parts, 0)).try_cast("double"),
            "longitude": F.trim(F.get(parts, 1)).try_cast("double"),
        }
    )


def explode_list(df: DataFrame, column: str, separator: str = ", ") -> DataFrame:
    """One row per element of a separated list."""
    return df.withColumn(column, F.explode(F.split(F.col(column), re.escape(separator))))


def parse_person_name(df: DataFrame, column: str) -> DataFrame:
    """Add Surname, Title and Firstname(s) from ``Surname, Title. First names``."""
    # fixed pattern
    pattern = r"^\s*([^,]+),\s*(.+?)\.?\s+(.*)$"
    name = F.col(column)
    matched = name.rlike(pattern)
    first = F.regexp_replace(strip_spaces(F.regexp_extract(name, pattern, 3)), '[()"“”]', "")
    return df.withColumns(
        {
            "Surname": F.when(matched, strip_spaces(F.regexp_extract(name, pattern, 1))).otherwise(""),
            "Title": F.when(matched, strip_spaces(F.regexp_extract(name, pattern, 2))).otherwise(""),
            "Firstname(s)": strip_spaces(F.when(matched, first).otherwise(name)),
        }
    )


def split_cabin(df: DataFrame, column: str) -> DataFrame:
    """Add the deck letter and the ship side given by the parity of the cabin number."""
    digits = F.regexp_extract(F.substring(column, 2, 4), "([0-9]+)", 1)
    number = F.when(digits != "", digits.cast("int"))
    return df.withColumns(
        {
            f"{column}_letter": F.substring(column, 1, 1),
            f"{column}_parite": F.when(number % 2 == 0, "Babord").when(number % 2 == 1, "Tribord"),
        }
    )


def number_without_separators(value: Column) -> Column:
    return F.replace(value, F.lit(","), F.lit("")).try_cast("double")


def number_before_unit(value: Column, unit: str) -> Column:
    return F.replace(value, F.lit(unit), F.lit("")).try_cast("double")


def id_text(value: Column) -> Column:
    """Float identifier shown as whole-number text."""
    return value.cast("bigint").cast("string")
