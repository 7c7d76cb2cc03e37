"""Normalisation as Column expressions: nulls and NaN are read as empty strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom import constants as C


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """Lower case, & spelled out, everything but word characters to single spaces."""
    s = F.replace(F.lower(F.coalesce(_col(c).cast("string"), F.lit(""))), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def words(cleaned: Column) -> Column:
    """The words of a cleaned string; none for an empty one."""
    return F.filter(F.split(cleaned, " "), lambda t: t != "")


def core_of(cleaned: Column) -> Column:
    noise = F.array(*[F.lit(x) for x in C.NOISE])
    return F.array_join(F.filter(words(cleaned), lambda t: ~F.array_contains(noise, t)), " ")


def name_core(c: Column | str) -> Column:
    return core_of(clean(c))


def split_name(c: Column | str) -> Column:
    """struct(primary, aliases): former names in parentheses, and other notes of over three characters, are aliases."""
    s = F.coalesce(_col(c).cast("string"), F.lit(""))
    named = F.transform(F.regexp_extract_all(s, F.lit(C.ALIAS), 1), lambda a: F.trim(a))
    rest = F.regexp_replace(F.regexp_replace(s, C.ALIAS, " "), C.STATUS, " ")
    notes = F.filter(F.transform(F.regexp_extract_all(rest, F.lit(r"\(([^)]*)\)"), 1), lambda a: F.trim(a)), lambda a: F.length(a) > 3)
    primary = F.trim(F.regexp_replace(F.regexp_replace(rest, r"\([^)]*\)", " "), r"(?U)\s+", " "))
    aliases = F.filter(F.transform(F.concat(named, notes), lambda a: F.trim(F.regexp_replace(a, C.STATUS, " "))), lambda a: a != "")
    return F.struct(primary.alias("primary"), aliases.alias("aliases"))


def status_note(c: Column | str) -> Column:
    return F.array_join(F.regexp_extract_all(F.coalesce(_col(c).cast("string"), F.lit("")), F.lit(C.STATUS), 0), " ")


def norm_address(c: Column | str) -> Column:
    s = F.regexp_replace(clean(c), r"(?U)\bp\s*o\s*box\b", "po box")
    known = F.create_map(*[F.lit(x) for pair in C.ADDRESS_WORDS.items() for x in pair])
    return F.array_join(F.transform(words(s), lambda t: F.coalesce(F.try_element_at(known, t), t)), " ")


def number_of(normed: Column) -> Column:
    """The leading street number of a normalised address, else box and its number, else empty."""
    lead = F.regexp_extract(normed, r"(?U)^(\d+[a-z]?)\b", 1)
    box = F.regexp_extract(normed, r"(?U)\b(?:po )?box (\w+)", 1)
    return F.when(lead != "", lead).when(box != "", F.concat(F.lit("box"), box)).otherwise("")


def body_of(normed: Column) -> Column:
    """A normalised address without its leading digits and one letter after them."""
    return F.trim(F.regexp_replace(normed, r"(?U)^\d+[a-z]?\s*", ""))


def street_number(c: Column | str) -> Column:
    return number_of(norm_address(c))


def street_body(c: Column | str) -> Column:
    return body_of(norm_address(c))


def norm_state(c: Column | str) -> Column:
    s = clean(c)
    known = F.create_map(*[F.lit(x) for pair in C.STATES.items() for x in pair])
    return F.when(F.length(s) == 2, F.upper(s)).otherwise(F.coalesce(F.try_element_at(known, s), F.substring(F.upper(s), 1, 2)))


def norm_zip5(c: Column | str) -> Column:
    """The first five digits, shorter ones filled with zeros on the left; empty without digits."""
    digits = F.regexp_replace(F.coalesce(_col(c).cast("string"), F.lit("")), "[^0-9]", "")
    return F.when(digits == "", "").when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(F.substring(digits, 1, 5))


def to_id(c: Column | str) -> Column:
    """An id as long: '12.0' is 12; fractions and other strings are null."""
    d = _col(c).try_cast("double")
    return F.when(d == F.floor(d), d.try_cast("bigint"))


def present(c: Column | str) -> Column:
    """The values of an array that are neither null nor blank."""
    return F.filter(_col(c), lambda x: x.isNotNull() & (F.trim(x) != ""))


def usable_names(c: Column | str) -> Column:
    """Names with enough characters to search by."""
    return F.filter(_col(c), lambda x: F.length(F.replace(clean(x), F.lit(" "), F.lit(""))) >= C.LEAST_NAME_CHARS)


def round1(c: Column | str) -> Column:
    """One decimal, halves to even on the tenfold."""
    return F.rint(_col(c) * 10) / 10
