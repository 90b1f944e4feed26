"""Text expressions. All of them stay native; none uses a Python function per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python counts as white space.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85"
    "\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_BREAK = "\x01 "


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space at both ends."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def title_case(c: Column | str) -> Column:
    """Stripped, a capital after every non-letter, lower case elsewhere.

    `initcap` alone starts a word only after a blank. Where a letter follows any other
    non-letter, a marked blank is put in between and taken out again afterwards. Most
    values need neither that nor stripping, which one test finds out.
    """
    # A lambda is no part of the generated code, which would be too long a method for Java to compile with a few such columns.
    return F.get(F.transform(F.array(col(c)), _cased), F.lit(0))


def _cased(value: Column) -> Column:
    special = (strip(value) != value) | value.rlike(r"[^\p{L} ]\p{L}")
    marked = F.regexp_replace(strip(value), r"([^\p{L} ])(?=\p{L})", "$1" + _BREAK)
    cased = F.replace(F.initcap(marked), F.lit(_BREAK), F.lit(""))
    return F.when(special, cased).otherwise(F.initcap(value))


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def map_values(c: Column | str, mapping: dict, keep_others: bool = True) -> Column:
    """Replace listed values; the others stay, or become null. For short lists, held as a literal map."""
    source = col(c)
    if not mapping:
        return source if keep_others else F.lit(None).cast("string")
    pairs = ", ".join(f"{_literal(k)}, {_literal(v)}" for k, v in mapping.items())
    found = F.try_element_at(F.expr(f"map({pairs})"), source)
    return F.coalesce(found, source) if keep_others else found


def normalise_enum(c: Column | str, mapping: dict[str, str] | None = None) -> Column:
    """Stripped, lower case, then aliases replaced."""
    return map_values(F.lower(strip(c)), mapping or {})


def icontains(c: Column | str, needle: str) -> Column:
    """Case-insensitive substring test; null counts as false."""
    return F.coalesce(F.lower(col(c)).contains(needle.lower()), F.lit(False))


def imatches(c: Column | str, pattern: str) -> Column:
    """Case-insensitive regular expression test; null counts as false."""
    return F.coalesce(col(c).rlike("(?iu)" + pattern), F.lit(False))


def is_blank(c: Column | str) -> Column:
    return col(c).isNull() | (strip(c) == "")


def all_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in cols])


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def yes_no(c: Column | str) -> Column:
    return F.when(col(c), "Yes").when(~col(c), "No")


def full_name(first: Column | str, last: Column | str) -> Column:
    """First and last name; null when either is null."""
    return F.concat(col(first), F.lit(" "), col(last))


def fmt_int(c: Column | str) -> Column:
    """Thousands separators, no decimals; a dash when empty."""
    return F.coalesce(F.format_number(col(c), 0), F.lit("—"))


def fmt_money(c: Column | str) -> Column:
    return F.coalesce(F.concat(F.lit("$"), F.format_number(col(c), 0)), F.lit("—"))


def fmt_fixed(c: Column | str, digits: int = 1, suffix: str = "") -> Column:
    """Fixed decimals, halves to even, then a suffix; a dash when empty."""
    text = F.format_string(f"%.{digits}f", F.bround(col(c).cast("double"), digits))
    return F.when(col(c).isNull(), "—").otherwise(F.concat(text, F.lit(suffix)))


def fmt_pct(c: Column | str, digits: int = 1) -> Column:
    return fmt_fixed(c, digits, "%")
