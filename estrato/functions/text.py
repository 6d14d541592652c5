"""Text rules of the silver layers, as native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that str.strip() of Python removes.
_SPACES = (
    *range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288,
)
WHITESPACE = "".join(map(chr, _SPACES))

# The texts that pandas.read_csv reads as missing.
CSV_NA = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The texts that count as empty in the discount columns.
EMPTY_TOKENS = ("", "nan", "NaN", "None", "NULL", "null")

BOM = chr(0xFEFF)


def strip(c: Column) -> Column:
    """Trim all Unicode whitespace (``trim`` of SQL removes spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    """``nullif(c, '')``."""
    return F.nullif(c, F.lit(""))


def na_to_null(c: Column, tokens: Sequence[str] = CSV_NA) -> Column:
    """NULL for any of the missing-value tokens, the text itself otherwise."""
    return F.when(~c.isin(*tokens), c)


def dataset_name(stem: Column) -> Column:
    """A file stem as a dataset name: ``[a-z0-9_]``, never starting with a digit."""
    s = F.replace(F.lower(strip(stem)), F.lit(BOM), F.lit(""))
    s = F.btrim(F.regexp_replace(s, r"[^a-z0-9]+", "_"), F.lit("_"))
    return (
        F.when(s == "", F.lit("t_unnamed"))
        .when(s.rlike("^[0-9]"), F.concat(F.lit("t_"), s))
        .otherwise(s)
    )


def column_name(header: Column) -> Column:
    """A header field as a column name: no BOM, trimmed, lower case, ``_`` for space."""
    s = strip(F.replace(header, F.lit(BOM), F.lit("")))
    return F.replace(F.lower(s), F.lit(" "), F.lit("_"))


def email(c: Column) -> Column:
    return F.lower(strip(c))


def match_flag(c: Column, expected: str, yes: str = "SIM", no: str = "NÃO") -> Column:
    """``yes`` where the text equals ``expected``, ``no`` elsewhere, NULL for NULL."""
    return F.when(c == F.lit(expected), F.lit(yes)).when(c.isNotNull(), F.lit(no))


def canonical_by_prefix(c: Column, names: dict[str, str]) -> Column:
    """Map by lower-case prefix (first listed wins); other values stay as they are."""
    out = None
    for prefix, name in names.items():
        test = F.lower(c).startswith(prefix)
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return c if out is None else out.otherwise(c)


def without_state(city: Column, state: str = "SP") -> Column:
    """City name without a trailing or embedded ``, SP`` / ``,SP``."""
    s = F.replace(city, F.lit(f", {state}"), F.lit(""))
    return F.trim(F.replace(s, F.lit(f",{state}"), F.lit("")))


def state_or(state: Column, default: str = "SP") -> Column:
    return F.coalesce(F.upper(blank_to_null(F.trim(state))), F.lit(default))


def or_unknown(c: Column, default: str = "unknown") -> Column:
    """Trimmed text; the default for NULL and for the empty text."""
    return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(strip(c))


def city_of(c: Column) -> Column:
    """Part before the first ``', '`` (the whole text without one)."""
    return strip(F.element_at(F.split(or_unknown(c), ", ", 2), 1))


def state_of(c: Column) -> Column:
    """Part after the first ``', '``, NULL without one."""
    return strip(F.try_element_at(F.split(or_unknown(c), ", ", 2), F.lit(2)))


def _code_text(c: Column) -> Column:
    head = F.trim(F.split_part(c, F.lit(" - "), F.lit(1)))
    return F.regexp_replace(head, r"\s+", "")


def _has_code(c: Column) -> Column:
    return F.contains(c, F.lit(" - ")) & _code_text(c).rlike("^[0-9]+$")


def code_of(c: Column) -> Column:
    """Numeric code of ``'12 - Label'``, whitespace inside it ignored; else NULL."""
    return F.when(_has_code(c), _code_text(c).try_cast("bigint"))


def label_of(c: Column, default: str = "OUTROS") -> Column:
    """Second part of ``'12 - Label - x'``; the default without a numeric code.

    A numeric code with an empty label gives NULL, not the default.
    """
    label = blank_to_null(F.trim(F.split_part(c, F.lit(" - "), F.lit(2))))
    return F.when(_has_code(c), label).otherwise(F.lit(default))
