"""Text functions with the semantics of Python's str and re, as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHITE = r"[\s\x1c-\x1f]"
#: The characters that str.strip takes for white space.
_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Stands between texts that are searched as one: neither a word character nor white space, and in no listing.
SEPARATOR = "\x01"
#: The pattern that takes any text whole.
ANY = "(?s)(.+)"


def py_strip(c: Column) -> Column:
    """Strips Unicode white space; Spark's trim leaves tabs and no-break spaces."""
    return F.btrim(c, F.lit(_BLANKS))


def words_of(c: Column) -> Column:
    """The words that splitting at white space gives; none of a blank text."""
    return F.filter(F.split(c, rf"(?U){_WHITE}+"), lambda w: w != "")


def rx(pattern: str, ignore_case: bool = True) -> str:
    """A pattern with Unicode classes, as Python reads it."""
    return f"(?{'i' if ignore_case else ''}U){pattern}"


def not_empty(c: Column) -> Column:
    """Null for an empty text. Unlike nullif it names its argument once, which then is evaluated once."""
    return F.get(F.array_remove(F.array(c), F.lit("")), F.lit(0))


def once(c: Column, look: Callable[[Column], Column]) -> Column:
    """``look(c)``, where c is evaluated once however often look names it."""
    return F.get(F.transform(F.array(c), look), F.lit(0))


def piece(text: Column, place: Column) -> Column:
    """The text at a place in the bytes of ``text``: 2 ** 32 times where it begins, and its length."""
    return F.substr(text, F.shiftright(place, 32).cast("int") + 1, place.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")).cast("string")


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def rx_first(c: Column, pattern: str, group: int = 1, ignore_case: bool = True, clean: Callable[[Column], Column] | None = None) -> Column:
    """The group of the first match, else null. An empty group counts as no match; no rule looks for one. On ASCII text,
    where both give the same, the pattern runs without Unicode classes, which are several times slower. clean: what is done
    first to texts that are not ASCII; it leaves ASCII as it is."""
    plain = f"(?i){pattern}" if ignore_case else pattern

    def look(x: Column) -> Column:
        return F.when(is_ascii(x), F.regexp_extract(x, plain, group)).otherwise(F.regexp_extract(x, rx(pattern, ignore_case), group))

    def cleaned(x: Column) -> Column:
        return F.when(is_ascii(x), F.regexp_extract(x, plain, group)).otherwise(once(clean(x), look))

    return F.get(F.array_remove(F.transform(F.array(c), cleaned if clean else look), F.lit("")), F.lit(0))


def first_of(values: Column, look: Callable[[Column], Column]) -> Column:
    """The first non-null result of ``look`` over an array."""
    return F.try_element_at(F.filter(F.transform(values, look), lambda x: x.isNotNull()), F.lit(1))


def _stays_inside(pattern: str) -> bool:
    """Can the pattern match no separator? Then texts joined by it can be searched at once."""
    bare = re.sub(r"\\[dws]|\\b|\\\$|\[(?!\^)(?:\\[dws.]|[^\]\\])*\]", "", pattern)
    return not re.search(r"[.\\^$]|\[\^", bare)


def first_match(values: Column, patterns: Sequence[str], group: int = 1, clean: Callable[[Column], Column] | None = None, hint: str = "", text: Column | None = None) -> Column:
    """The first match of any pattern in the first text that has one: texts outside, patterns inside. clean: see ``rx_first``.
    hint: lower-case text that every match holds in some case; texts without it are passed over before any pattern runs. One
    pattern that cannot match the separator runs once over all texts joined, where the leftmost match is the first text's.
    text: values are places in its bytes (``piece``), which are read one after the other up to the first match, so that no more
    than one is held at a time."""

    def hinted(d: Column) -> Column:
        other = F.contains(F.translate(F.lower(clean(d) if clean else d), "ſ", "s"), F.lit(hint))
        return F.when(is_ascii(d), F.contains(F.lower(d), F.lit(hint))).otherwise(other)

    def look(d: Column) -> Column:
        return F.coalesce(*(not_empty(d) if p == ANY and group < 2 and not clean else rx_first(d, p, group, clean=clean) for p in patterns))

    if text is not None:
        found = lambda d: F.when(hinted(d), look(d)) if hint else look(d)
        at = lambda t: F.aggregate(values, F.lit(None).cast("bigint"), lambda known, p: F.coalesce(known, once(piece(t, p), lambda d: F.when(found(d).isNotNull(), p))))
        return once(text, lambda t: once(piece(t, at(t)), found))
    if hint:
        values = F.filter(values, hinted)
    if len(patterns) == 1 and _stays_inside(patterns[0]):
        return rx_first(F.array_join(values, SEPARATOR), patterns[0], group, clean=clean)
    return first_of(values, look)


def unify_dashes(c: Column) -> Column:
    """Non-breaking hyphen, en dash and em dash become the hyphen."""
    for dash in "‑–—":
        c = F.replace(c, F.lit(dash), F.lit("-"))
    return c


def to_int(c: Column) -> Column:
    return c.try_cast("bigint").cast("int")


def remove_commas(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit("")).try_cast("bigint")


def multiply_1000(c: Column) -> Column:
    """Thousands, cut to whole numbers."""
    return (c.try_cast("double") * 1000).cast("bigint")


def handle_k_miles(c: Column) -> Column:
    """A number with a k counts thousands."""
    plain = F.replace(c, F.lit(","), F.lit(""))
    return F.when(F.contains(F.lower(c), F.lit("k")), multiply_1000(F.regexp_replace(plain, "(?i)k", ""))).otherwise(plain.try_cast("bigint"))


#: Named value transforms; users may add their own.
TRANSFORMS: dict[str, Callable[[Column], Column]] = {
    "multiply_1000": multiply_1000,
    "handle_k_miles": handle_k_miles,
    "remove_commas": remove_commas,
    "identity": lambda c: c,
}


def short_date(c: Column) -> Column:
    """ISO text of month/day/two-digit year: 69 to 99 lie in the 1900s. Any other number of year digits gives null."""
    part = F.split(c, "/")
    year = part[2].try_cast("int")
    iso = F.concat(F.when(year >= 69, year + 1900).otherwise(year + 2000).cast("string"), F.lit("-"), part[0], F.lit("-"), part[1])
    return F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), F.date_format(F.try_to_date(iso, "yyyy-M-d"), "yyyy-MM-dd"))
