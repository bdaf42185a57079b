"""Names, keys and codes, as Column expressions."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed words that keep capitals, and small words, in titles.
KEEP_UPPER = ("MTR", "KMB", "CTB", "GMB", "NLB", "LR", "I", "II", "III", "IV", "V", "BBI", "EKCC", "H.K.", "GTC")
KEEP_LOWER = ("of", "the", "and", "at", "in", "on", "to", "for", "with", "by")
#: Fixed words that mark a service variant.
VARIANT_WORDS = ("VIA", "OMIT", "SPECIAL", "EXPRESS", "SERVICE", "CORRECTIONAL")


def _cased(word: Column, first: Column) -> Column:
    rest = F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, F.lit(2), F.length(word))))
    return F.when(F.upper(word).isin(*KEEP_UPPER), F.upper(word)).when(~first & F.lower(word).isin(*KEEP_LOWER), F.lower(word)).otherwise(rest)


def smart_title_case(text: Column) -> Column:
    """Title case for texts of which half is capitals: acronyms stay, small words are lowered, parts in brackets begin anew.

    A bracket that is not closed, or not opened, stays with its word.
    """
    blank_free = lambda part: F.filter(F.split(part, r"\s+"), lambda w: w != "")
    every = F.regexp_extract_all(text, F.lit(r"\([^()]*\)|\(?[^()]+\)?|[()]"), F.lit(0))
    pieces = F.filter(every, lambda p: F.size(blank_free(p)) > 0)
    bracketed = lambda p: p.startswith("(") & p.endswith(")")

    def hyphened(word: Column, first: Column) -> Column:
        return F.array_join(F.transform(F.split(word, "-"), lambda h, i: _cased(h, first & (i == 0))), "-")

    def rendered(piece: Column, before: Column) -> Column:
        inner = F.array_join(F.transform(blank_free(F.regexp_replace(piece, r"^\(|\)$", "")), lambda w, j: _cased(w, j == 0)), " ")
        outer = F.array_join(F.transform(blank_free(piece), lambda w, j: hyphened(w, (j == 0) & (before == 0))), " ")
        return F.when(bracketed(piece), F.concat(F.lit("("), inner, F.lit(")"))).otherwise(outer)

    # number of earlier pieces outside brackets decides whether a word is the first
    numbered = F.aggregate(pieces, F.struct(F.lit(0).alias("n"), F.array().cast("array<string>").alias("out")), lambda a, p: F.struct((a["n"] + F.when(bracketed(p), 0).otherwise(1)).alias("n"), F.concat(a["out"], F.array(rendered(p, a["n"]))).alias("out")), lambda a: F.array_join(a["out"], " "))
    capitals = F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}", ""))
    return F.when(2 * capitals < F.length(text), text).otherwise(numbered)


def clean_stop_name(name: Column, title: bool = True) -> Column:
    """Without a five-character code in brackets, one space around a dash and before a bracket that holds one code of letters and digits."""
    uncoded = F.regexp_replace(name, r"\s*\([A-Za-z0-9]{5}\)", "")
    bare = F.regexp_replace(F.regexp_replace(uncoded, r"\s*-\s*", " - "), r"(\S)(\([A-Za-z0-9]+\))", "$1 $2")
    return smart_title_case(bare) if title else bare


def part_of(key: Column, i: int, separator: str = "-") -> Column:
    """The i-th part of a composite key, null if there is none."""
    return F.get(F.split(key, separator), F.lit(i))


def route_short_name(route_id: Column) -> Column:
    """What follows the agency in AGENCY-NAME...; region and code of a three-part GMB id; an id without a dash itself."""
    parts = F.split(route_id, "-")
    at = lambda i: F.get(parts, F.lit(i))
    return F.when((F.size(parts) == 3) & (at(0) == "GMB"), F.concat_ws("-", at(1), at(2))).when(F.size(parts) >= 2, at(1)).otherwise(route_id)


def split_first(text: Column, separators: list[str]) -> Column:
    """Struct (origin, destination) at the first separator of the list that occurs; both the whole text if none does."""
    out = F.struct(F.trim(text).alias("origin"), F.trim(text).alias("destination"))
    for one in reversed(separators):
        quoted = "\\Q" + one + "\\E"
        parts = F.split(text, quoted, 2)
        out = F.when(F.instr(text, one) > 0, F.struct(F.trim(F.get(parts, F.lit(0))).alias("origin"), F.trim(F.get(parts, F.lit(1))).alias("destination"))).otherwise(out)
    return out


def split_name_pair(name: Column) -> Column:
    """Struct (origin, destination) of 'A > B'; without a destination both are the origin; hard spaces are spaces."""
    parts = F.split(F.replace(name, F.lit(" "), F.lit(" ")), " > ", 2)
    return F.struct(F.get(parts, F.lit(0)).alias("origin"), F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0))).alias("destination"))


def norm_text(text: Column) -> Column:
    return F.upper(F.trim(F.coalesce(text, F.lit(""))))


def exit_code(ref: Column, name_en: Column, name_zh: Column) -> Column:
    """Code of a station exit: its reference, else after 'Exit' in the English name, else at the start of the Chinese one."""
    found = lambda c, p: F.nullif(F.upper(F.regexp_extract(F.coalesce(c, F.lit("")), p, 1)), F.lit(""))
    return F.coalesce(F.nullif(norm_text(ref), F.lit("")), found(name_en, r"(?i)Exit\s+([A-Z][0-9]*)"), found(F.trim(name_zh), r"^([A-Za-z][0-9]*)"))


def exit_codes(text: Column) -> Column:
    """All codes of a capital and digits in a text."""
    return F.regexp_extract_all(text, F.lit("[A-Z][0-9]*"), F.lit(0))


def direction_of(name: Column, origin: Column) -> Column:
    """0 if the name is missing or 'A > B' with A the origin, else 1."""
    return F.when(name.isNull(), 0).when((F.instr(name, " > ") > 0) & (F.get(F.split(name, " > "), F.lit(0)) == origin), 0).otherwise(1)


def direction_letter(text: Column) -> Column:
    """O or I for outbound/inbound in any spelling, else the text in capitals."""
    low = F.lower(F.trim(text))
    return F.when(low.isin("outbound", "o", "1"), "O").when(low.isin("inbound", "i", "2"), "I").otherwise(F.upper(F.trim(text)))


def trip_direction(trip_id: Column) -> Column:
    """O, I or UNKNOWN from the second part of a government trip id."""
    two = F.split_part(trip_id, F.lit("-"), F.lit(2))
    return F.when(two == "1", "O").when(two == "2", "I").otherwise("UNKNOWN")


def swap_bound(bound: Column) -> Column:
    return F.when(bound == "O", "I").when(bound == "I", "O").when(bound == "outbound", "inbound").when(bound == "inbound", "outbound").otherwise(bound)


def strip_departure(trip_id: Column) -> Column:
    """A trip id without its four-digit departure."""
    return F.regexp_replace(trip_id, r"-\d{4}$", "")


def without_prefix(stop_id: Column) -> Column:
    """What stands after the first dash; the whole id without one."""
    return F.regexp_replace(stop_id, "^[^-]*-", "")


def is_variant_name(name: Column) -> Column:
    """Whether a name, without what is in brackets, holds a word of a service variant."""
    bare = F.regexp_replace(F.upper(name), r"\([^)]*\)", " ")
    out = F.lit(False)
    for word in VARIANT_WORDS:
        out = out | bare.contains(word)
    return out


def is_circular(*names: Column) -> Column:
    """Whether a name says in English or Chinese that a route is circular."""
    out = F.lit(False)
    for name in names:
        out = out | F.coalesce(name.rlike("(?i)circular") | name.rlike("循環|环线|循环"), F.lit(False))
    return out


def with_circular(name: Column, circular: Column) -> Column:
    return F.when(circular & ~F.lower(name).contains("circular"), F.concat(name, F.lit(" (Circular)"))).otherwise(name)


def hex_color(value: Column) -> Column:
    """Six hexadecimal digits in capitals without '#', or null."""
    bare = F.upper(F.regexp_replace(F.trim(value), "^#", ""))
    return F.when(bare.rlike("^[0-9A-F]{6}$"), bare)


def text_color(color: Column) -> Column:
    """Black on colours whose luma is 186 or more, else white."""
    part = lambda i: F.conv(F.substring(color, i, 2), 16, 10).try_cast("int")
    luma = 299 * part(1) + 587 * part(3) + 114 * part(5)  # in thousandths: whole numbers meet 186 exactly
    return F.when(color.isNotNull(), F.when(luma >= 186_000, "000000").otherwise("FFFFFF"))


def similarity(a: Column, b: Column) -> Column:
    """100 times one less the edit distance over the longer length."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 100.0).otherwise(100.0 * (1 - F.levenshtein(a, b) / longest))


def without_none(text: Column) -> Column:
    """'' for null and the words that stand for it."""
    return F.when(text.isNull() | F.lower(F.trim(text)).isin("nan", "none"), "").otherwise(text)


def unescape(text: Column) -> Column:
    """Without a byte-order mark, and with the characters that HTML entities stand for; only texts with an ampersand go to Python."""
    bare = F.replace(text, F.lit("\ufeff"), F.lit(""))

    @F.pandas_udf("string")
    def entities(texts: pd.Series) -> pd.Series:
        return texts.map(html.unescape, na_action="ignore")

    return F.coalesce(entities(F.when(bare.contains("&"), bare)), bare)


def sequence_number(text: Column) -> Column:
    """A whole number from texts such as '1.00'; null if there is none."""
    return text.try_cast("double").try_cast("int")


def route_key(route: Column, bound: Column) -> Column:
    """ROUTE_BOUND, with one bound for circular routes whose bound is neither 1 nor 2."""
    return F.concat_ws("_", route, F.when(bound.isin("1", "O"), "O").when(bound.isin("2", "I"), "I").otherwise("O"))
