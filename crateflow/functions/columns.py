"""Column expressions of the three layers; all stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# what a number may look like once its thousands separators are gone; Spark's
# own cast would also take '1d' and ' 1 '
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# The characters Unicode counts as white space.
_BLANKS = (
    "\t\n\u000b\f\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# the separator of packed lists is not documented, so all common ones count
_LIST_SEPARATOR = r"[,;|]"


def _bare(name: str) -> Column:
    return F.replace(F.col(name), F.lit(","), F.lit(""))


def number(name: str) -> Column:
    """Text with thousands separators to double; anything else raises."""
    bare = _bare(name)
    failure = F.raise_error(F.concat(F.lit(f"{name}: not a number: "), bare)).cast("double")
    return F.when(bare.rlike(_NUMBER), bare.cast("double")).when(bare.isNotNull(), failure)


def is_number(name: str) -> Column:
    """Whether ``number(name)`` would give a value."""
    return _bare(name).rlike(_NUMBER)


def day(name: str, date_format: str) -> Column:
    """Text to date by ``date_format``; what does not parse becomes NULL."""
    return F.try_to_date(F.col(name), date_format)


def plain_text(name: str) -> Column:
    """Without blanks of any script at both ends, in upper case."""
    return F.upper(F.trim(F.col(name), F.lit(_BLANKS)))


def source_name(file: Column) -> Column:
    """File name without its last extension; leading dots belong to the name."""
    return F.regexp_replace(file, r"^(\.*[^.].*)\.[^.]*$", "$1")


def packed_list(name: str) -> Column:
    """The non-empty, trimmed items of a list kept in one string."""
    items = F.transform(F.split(name, _LIST_SEPARATOR), lambda item: F.trim(item))
    return F.array_distinct(F.filter(items, lambda item: item != ""))


def whole(name: str) -> Column:
    """A year or month that may arrive as '7' or '7.0'; NULL if it is neither."""
    value = F.col(name).try_cast("double")
    return F.when(value == F.floor(value), value.try_cast("int"))


def first_of_month(year: Column, month: Column) -> Column:
    """First day of a month; an impossible month gives NULL."""
    return F.when(month.between(1, 12) & year.between(1, 9999), F.make_date(year, month, F.lit(1)))


def date_key(date: Column) -> Column:
    """A date as the number YYYYMMDD."""
    return F.date_format(date, "yyyyMMdd").cast("int")


def money_sum(value: str | Column) -> Column:
    """Sum of amounts that does not depend on the order of addition.

    Doubles are added as decimals of four places: partial sums of a large
    table come together in any order, and plain doubles would then differ
    from run to run.
    """
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(value.cast("decimal(18,4)")).cast("double")


def share(part: Column, base: Column) -> Column:
    """``part / base``; NULL when the base is zero."""
    return F.try_divide(part.cast("double"), base.cast("double"))
