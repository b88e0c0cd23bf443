"""Accent folding as Spark expressions.

Spark has no Unicode normalization function.  The compatibility decomposition
(NFKD) with marks dropped is a per-character mapping, so it is derived here by
rule from Python's own Unicode data and handed to Spark as literals:
``translate`` covers every character that folds to one character, and a guarded
per-character lookup covers the few that fold to several.
"""

import json
import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def class_of(ranges) -> str:
    """A regex character class (Java syntax) from code point ranges.

    Long classes are tested range by range, so one cheap test rules out the
    wide spans below U+2000 without a member, where nearly all text lies.
    """
    def written(spans):
        return "[" + "".join(
            rf"\x{{{lo:X}}}" if lo == hi else rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in spans
        ) + "]"

    empty, start = [], 0
    for lo, hi in sorted(ranges):
        if start < 0x2000 and lo - start >= 0x20:
            empty.append((start, min(lo, 0x2000) - 1))
        start = hi + 1
    skip = f"(?!{written(empty)})" if empty else ""
    return f"(?:{skip}{written(ranges)})"


@cache
def _folding():
    """(one-to-one, one-to-many) foldings of every character but Hangul."""
    one, many = {}, {}
    planes = [(0x80, HANGUL_FIRST), (HANGUL_LAST + 1, 0xD800),
              (0xE000, 0x20000), (0x2F800, 0x2FA20)]
    for lo, hi in planes:
        for char in map(chr, range(lo, hi)):
            if unicodedata.category(char).startswith("M"):
                continue
            folded = "".join(
                c for c in unicodedata.normalize("NFKD", char)
                if not unicodedata.category(c).startswith("M")
            )
            if folded != char:
                (one if len(folded) == 1 else many)[char] = folded
    return one, many


def _ranges(chars):
    points = sorted(map(ord, chars))
    start = previous = points[0]
    for point in points[1:]:
        if point != previous + 1:
            yield start, previous
            start = point
        previous = point
    yield start, previous


def _jamo(code: Column) -> Column:
    return F.decode(F.unhex(F.hex(code)), "UTF-16BE")


def _hangul(char: Column) -> Column:
    """A Hangul syllable as its two or three letters (arithmetic mapping)."""
    index = F.ascii(char) - HANGUL_FIRST
    tail = index % 28
    return F.concat(
        _jamo((F.floor(index / 588) + 0x1100).cast("bigint")),
        _jamo((F.floor((index % 588) / 28) + 0x1161).cast("bigint")),
        F.when(tail > 0, _jamo((tail + 0x11A7).cast("bigint"))).otherwise(""),
    )


def fold_accents(text: Column, *, blank=()) -> Column:
    """NFKD with combining marks removed.

    Characters in the ``blank`` ranges become a space instead.
    """
    one, many = _folding()
    blanks = {chr(point): " " for lo, hi in blank for point in range(lo, hi + 1)}
    one = {**one, **blanks}
    many = {c: folded for c, folded in many.items() if c not in blanks}
    expanding = class_of([*_ranges(many), (HANGUL_FIRST, HANGUL_LAST)])
    table = F.from_json(F.lit(json.dumps(many)), "map<string,string>")

    def expand(text):
        return F.array_join(
            F.transform(
                F.split(text, ""),
                lambda c: F.when(
                    c.between(chr(HANGUL_FIRST), chr(HANGUL_LAST)), _hangul(c)
                ).otherwise(F.coalesce(F.try_element_at(table, c), c)),
            ),
            "",
        )

    # Most texts contain none of the expanding characters and skip the lookup.
    text = let(text, lambda t: F.when(t.rlike(expanding), expand(t)).otherwise(t))
    text = F.translate(text, "".join(one), "".join(one.values()))
    return F.regexp_replace(text, r"\p{M}+", "")


def fold_to_ascii(text: Column) -> Column:
    """NFKD, then everything outside ASCII dropped."""
    return F.regexp_replace(fold_accents(text), r"[^\x00-\x7F]+", "")
