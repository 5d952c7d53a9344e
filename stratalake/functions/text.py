"""Column expressions over code and title text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def academic_year(year: Column) -> Column:
    """1999 -> ``1999-00``."""
    following = (year.cast("int") + F.lit(1)).cast("string")
    return F.concat(year.cast("string"), F.lit("-"), F.right(following, F.lit(2)))


def spreadsheet_code(col: Column) -> Column:
    """Code lists exported for spreadsheets write codes as ``="01"``; keep the code alone."""
    return F.regexp_replace(col, '[="]', "")


def code_prefix(col: Column, length: int = 2) -> Column:
    return F.substring(col, 1, length)


def display_title(code: Column, title: Column, overrides: Mapping[str, str]) -> Column:
    """Sentence-case title cut before "and related ..."; codes listed in ``overrides`` get their own text."""
    rest = title.substr(F.lit(2), F.length(title))
    sentence = F.concat(F.upper(F.substring(title, 1, 1)), F.lower(rest))
    tidy = F.regexp_replace(sentence, " and related.*", "")
    if not overrides:
        return tidy
    pairs = [F.lit(part) for pair in overrides.items() for part in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), code), tidy)
