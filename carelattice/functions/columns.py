"""Column functions: text, dates and codes as native expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$", "")


def strip_column(c: Column) -> Column:
    """strip of a column or a lambda's variable (not of an expression: c is repeated), for texts of any length: only ends are compared, no pattern runs over the text.

    Before a last U+0085, U+2028 or U+2029 the pattern's `$` matches as well, so there the pattern stays.
    """
    other_end = c.endswith("\x85") | c.endswith("\u2028") | c.endswith("\u2029")
    return F.when(other_end, strip(c)).otherwise(F.btrim(c, F.lit(" \t\n\x0b\f\r\x1c\x1d\x1e\x1f")))


def not_blank(c: Column) -> Column:
    """strip leaves something of c: found at its first character that isn't white space. False for null."""
    return F.coalesce(c.rlike(r"[^\s\x{1c}-\x{1f}]"), F.lit(False))


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """rows with a value that comes out of a generator, so that Spark doesn't copy its expression to each use."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(blank_to_null(c) for c in columns))


def normal_name(c: Column) -> Column:
    """Upper case, white space collapsed, empty to null."""
    return blank_to_null(F.regexp_replace(strip(F.upper(c)), r"\s+", " "))


def part(c: Column, delimiter: str, i: int) -> Column:
    """The i-th part of c, null if there are fewer."""
    return F.get(F.split(c, re.escape(delimiter)), F.lit(i))


def lookup(c: Column, table: Mapping[str, str], default: Column | None = None) -> Column:
    """c through a fixed table, as a literal map; else default."""
    entries = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    found = F.try_element_at(entries, c)
    return found if default is None else F.coalesce(found, default)


def minimal_prefixes(prefixes: Iterable[str]) -> list[str]:
    """Prefixes without those that another one covers."""
    kept: list[str] = []
    for p in sorted(set(prefixes)):
        if not kept or not p.startswith(kept[-1]):
            kept.append(p)
    return kept


def has_prefix(c: Column, prefixes: str) -> Column:
    """c begins with one of these (space-separated) prefixes: one anchored pattern."""
    return c.rlike("^(" + "|".join(re.escape(p) for p in minimal_prefixes(prefixes.split())) + ")")


# --- dates -------------------------------------------------------------------------------------------------------

# What two-digit date fields may look like where one digit is allowed too.
_FIELDS = {"Y": r"(\d{4})", "m": r"(1[0-2]|0[1-9]|[1-9])", "d": r"(3[01]|[12]\d|0[1-9]|[1-9])", "H": r"(2[0-3]|[01]\d|\d)", "M": r"([0-5]\d|\d)", "S": r"(6[01]|[0-5]\d|\d)"}


def hl7_timestamp(c: Column, lenient: bool = False) -> Column:
    """yyyyMMdd[HHmm[ss]] without its offset; null if empty or no such time.

    lenient: fields of one digit are accepted wherever the whole still fits, from the longest form to the shortest.
    """
    raw = strip(F.substring_index(F.substring_index(c, "+", 1), "-", 1))
    n = F.length(raw)
    if not lenient:
        at = lambda size, pattern: F.try_to_timestamp(F.substr(raw, F.lit(1), F.lit(size)), F.lit(pattern))
        digits = lambda size: raw.rlike(rf"^\d{{{size}}}")
        return F.when((n >= 14) & digits(14), at(14, "yyyyMMddHHmmss")).when((n >= 12) & (n < 14) & digits(12), at(12, "yyyyMMddHHmm")).when((n >= 8) & (n < 12) & digits(8), at(8, "yyyyMMdd"))
    tries = []
    for size, form in ((14, "YmdHMS"), (12, "YmdHM"), (8, "Ymd")):
        text = F.substr(raw, F.lit(1), F.lit(size))
        pattern = "^" + "".join(_FIELDS[f] for f in form)
        whole = F.length(F.regexp_extract(text, pattern, 0)) == F.length(text)
        got = [F.regexp_extract(text, pattern, i + 1).try_cast("int") for i in range(len(form))] + [F.lit(0)] * (6 - len(form))
        tries.append(F.when(whole & (n > 0), F.try_make_timestamp(*got[:5], got[5].cast("double"))))
    return F.coalesce(*tries)


def hl7_date(c: Column) -> Column:
    """The first eight characters as a date."""
    text = F.substr(strip(c), F.lit(1), F.lit(8))
    return F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd"))


def hl7_datetime(c: Column) -> Column:
    """14 characters as a time or, if there are fewer, 8 as a date; a bad longer value doesn't fall back."""
    text = strip(c)
    n = F.length(text)
    full, day = F.substr(text, F.lit(1), F.lit(14)), F.substr(text, F.lit(1), F.lit(8))
    return F.when(n >= 14, F.when(full.rlike(r"^\d{14}$"), F.try_to_timestamp(full, F.lit("yyyyMMddHHmmss")))).when((n >= 8) & day.rlike(r"^\d{8}$"), F.try_to_timestamp(day, F.lit("yyyyMMdd")))


def iso_timestamp(c: Column) -> Column:
    """An ISO date or time; a trailing Z or offset is dropped, not applied."""
    return F.try_to_timestamp(F.regexp_replace(strip(c), r"(Z|[+-]\d{2}:?\d{2})$", ""))


def iso_date(c: Column) -> Column:
    """Strictly yyyy-MM-dd and a real date."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(c, "yyyy-MM-dd"))


def to_float(c: Column) -> Column:
    """A decimal number as Python reads it, or null."""
    text = strip(c)
    ok = text.rlike(r"(?i)^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?$|^[+-]?(nan|inf|infinity)$")
    return F.when(ok, F.regexp_replace(text, "_", "").try_cast("double"))


def micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def age(birth: Column, at: Column) -> Column:
    """Whole years; who is born on 29 February has their birthday on 1 March in other years."""
    before = (F.month(at) < F.month(birth)) | ((F.month(at) == F.month(birth)) & (F.dayofmonth(at) < F.dayofmonth(birth)))
    return F.year(at) - F.year(birth) - before.cast("int")


def one_decimal(c: Column) -> Column:
    """A double to one decimal, half to even, by its exact binary value: 8.35, which is a little less, gives 8.3.

    The fraction is a whole number of 2^-58 (for values from 1/64), so that its tenths and their remainder are exact longs.
    """
    size = F.abs(c)
    tenths = ((size - F.floor(size)) * float(1 << 58)).cast("long") * 10
    whole, rest, half = F.shiftright(tenths, 58), tenths.bitwiseAND((1 << 58) - 1), F.lit(1 << 57)
    up = (rest > half) | (rest == half) & (whole % 2 == 1)
    value = (F.floor(size) * 10 + whole + up.cast("long")) / F.lit(10.0)
    return F.when(c < 0, -value).otherwise(value)


def stable_id(*columns: Column | str) -> Column:
    """A deterministic id from a natural key."""
    return F.sha2(F.concat_ws("~", *(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns)), 256)


def hash_umpi(c: Column) -> Column:
    return F.sha2(c.cast("string"), 256)


def risk_tier(score: Column) -> Column:
    return F.when(score <= 0, "LOW").when(score <= 2, "MODERATE").when(score <= 4, "HIGH").otherwise("VERY_HIGH")
