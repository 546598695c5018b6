"""Text cleaning, combination keys and identifiers."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

from paceline.keys import ORDERED_BETS

# Markers for tickets that were not sold.
UNSOLD = ["-", "【未発売】"]


@functools.cache
def _foldings() -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """NFKC of the Basic Multilingual Plane: one character to one, one to several, base plus mark to one."""
    plane = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    folded = {c: unicodedata.normalize("NFKC", c) for c in plane}
    single = {c: d for c, d in folded.items() if d != c and len(d) == 1}
    several = {c: d for c, d in folded.items() if len(d) > 1}
    pairs = {}
    for c in plane:
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            pair = "".join(chr(int(x, 16)) for x in parts)
            if unicodedata.normalize("NFC", pair) == c:
                pairs[pair] = c
    return single, several, pairs


def _any_of(chars: Iterable[str]) -> str:
    """A pattern for one of the characters, neighbours as ranges."""
    codes = {ord(c) for c in chars}
    starts = sorted(c for c in codes if c - 1 not in codes)
    ends = sorted(c for c in codes if c + 1 not in codes)
    return "[" + "".join(f"\\u{x:04X}-\\u{y:04X}" for x, y in zip(starts, ends)) + "]"


def _lookup(table: dict[str, str]) -> Column:
    """The table as one folded literal; control characters part its entries."""
    text = "\x01".join(f"{k}\x02{v}" for k, v in table.items())
    return F.str_to_map(F.lit(text), F.lit("\x01"), F.lit("\x02"))


def nfkc(col: Column) -> Column:
    """Compatibility forms to plain ones, as Unicode's NFKC does.

    Characters of the Basic Multilingual Plane are folded, and a base is joined with the marks behind
    it in their order. Marks are not reordered, and Hangul letters are not joined to syllables.
    """
    single, several, pairs = _foldings()
    plain = F.translate(col, "".join(single), "".join(single.values()))
    letters = lambda text: F.split(text, "")
    spread = F.array_join(F.transform(letters(plain), lambda c: F.coalesce(F.try_element_at(_lookup(several), c), c)), "")
    wide = F.when(plain.rlike(_any_of(several)), spread).otherwise(plain)

    def join(done: Column, c: Column) -> Column:
        size = F.length(done)
        whole = F.try_element_at(_lookup(pairs), F.concat(F.right(done, F.lit(1)), c))
        return F.when(whole.isNotNull(), F.concat(F.substring(done, F.lit(1), F.greatest(size - 1, F.lit(0))), whole)).otherwise(F.concat(done, c))

    composed = F.when(wide.rlike(_any_of(k[1] for k in pairs)), F.aggregate(letters(wide), F.lit(""), join)).otherwise(wide)
    # Plain ASCII, nearly every text, is left at the first look.
    return F.when(col.rlike(r"[^\x00-\x7F]"), composed).otherwise(col)


def clean_text(col: Column) -> Column:
    """NFKC, then trim; blank and the word ``null`` become NULL."""
    trimmed = F.trim(nfkc(col))
    return F.when((col == "null") | (trimmed == ""), None).otherwise(trimmed)


def clean_int(col: Column) -> Column:
    return F.trim(col).try_cast("int")


def clean_double(col: Column) -> Column:
    return clean_text(col).try_cast("double")


def money(col: Column) -> Column:
    """``"8,460"`` to 8460, ``"(3)"`` to 3, unsold markers to NULL."""
    text = clean_text(col)
    return F.when(text.isin(UNSOLD), None).otherwise(F.regexp_replace(text, "[,()]", "")).try_cast("int")


def truthy(col: Column) -> Column:
    """Text flags: ``true`` (any case) and ``1``; NULL counts as false."""
    return F.coalesce(F.lower(F.trim(col.cast("string"))).isin("true", "1"), F.lit(False))


def join_cars(cars: Column, separator: str) -> Column:
    return F.array_join(cars.cast("array<string>"), separator)


def format_combo(raw: Column, bet_type: Column) -> Column:
    """``"0102"`` to ``1-2`` for ordered bets, ``1=2`` ascending for the others."""
    cars = F.transform(F.regexp_extract_all(raw, F.lit(r"(\d{2})"), F.lit(1)), lambda x: x.cast("int"))
    return F.when(bet_type.isin(ORDERED_BETS), join_cars(cars, "-")).otherwise(join_cars(F.array_sort(cars), "="))


def car_numbers(kumi: Column) -> Column:
    """The car numbers of a combination; unparsable parts become NULL."""
    return F.transform(F.split(kumi, "[-=]"), lambda x: x.try_cast("int"))


def car_at(kumi: Column, place: int) -> Column:
    return F.get(F.split(kumi, "[-=]"), F.lit(place - 1)).try_cast("int")


def pair_of(text: Column) -> Column:
    """``(lo, hi)`` as a struct when the text holds exactly two different numbers, else NULL."""
    nums = F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.try_cast("int"))
    a, b = F.get(nums, F.lit(0)), F.get(nums, F.lit(1))
    return F.when(
        (F.size(nums) == 2) & (a != b),
        F.struct(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")),
    )


def race_id(date: Column, place: Column, race: Column) -> Column:
    """``yyyymmdd`` followed by two-digit venue and race numbers (longer numbers are kept whole)."""

    def two(c: Column) -> Column:
        s = c.cast("string")
        return F.when(F.length(s) < 2, F.lpad(s, 2, "0")).otherwise(s)

    return F.concat(F.date_format(date, "yyyyMMdd"), two(place), two(race))


def race_key(cols: Sequence[Column], separator: str = "|") -> Column:
    return F.concat_ws(separator, *[c.cast("string") for c in cols])
