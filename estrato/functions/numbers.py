"""Number rules: Brazilian decimals, lenient integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estrato.functions.text import EMPTY_TOKENS, strip


_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _number(c: Column) -> Column:
    """Text as DOUBLE where it is a plain number (Java alone would also take ``1d``)."""
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def _plain(c: Column) -> Column:
    """Drop every ``.``, then turn ``,`` into ``.``."""
    return F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit("."))


def br_decimal(c: Column, scale: int = 2) -> Column:
    """``1.234,56`` as 1234.56; every dot is a thousands mark, so ``12.50`` is 1250.

    Rounded once, half up.  The type is wide: a value that a narrower column of a table
    can't hold is an error when it is written there, not NULL.
    """
    return _plain(strip(c)).try_cast(f"decimal(38,{scale})")


def whole_number(c: Column) -> Column:
    """Nullable integer; text that is no number is NULL, a fraction is cut off.

    Exact for every 64-bit integer; only text with an exponent goes through DOUBLE.
    """
    s = strip(c)
    whole = F.regexp_replace(F.regexp_replace(s, r"\..*$", ""), r"^([+-]?)$", "$10")
    plain = F.when(s.rlike(_NUMBER), whole.try_cast("decimal(38,0)").try_cast("bigint"))
    return F.when(s.rlike("[eE]"), _number(s).try_cast("bigint")).otherwise(plain)


def digits_int(c: Column) -> Column:
    """Integer of the digits and minus signs in the text (``25°``, ``/20``), else NULL."""
    return F.regexp_replace(c, "[^0-9-]", "").try_cast("int")


def digit_text_int(c: Column) -> Column:
    """Integer only where the text is nothing but digits."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int"))


# Zero with any ``%`` and ``.`` in it, which are dropped, and ``,`` as the decimal mark.
_ZERO = r"[%.]*[+-]?[%.]*(?:0[0%.]*(?:,[0%.]*)?|,[%.]*0[0%.]*)(?:[eE][%.]*[+-]?[0-9%.]*[0-9][%.]*)?\s*[%.]*"


def is_empty_or_zero(c: Column) -> Column:
    """True for NULL, blank and NA tokens, and for 0 after ``%`` and dots are dropped.

    One pattern on one reference of the column: in a filter Spark puts the expression
    behind the column in the place of every reference to it.
    """
    tokens = "|".join(EMPTY_TOKENS)
    return F.coalesce(strip(c), F.lit("")).rlike(f"^(?:{tokens}|{_ZERO})$")
