"""Text functions: Column in, Column out, no Python in the data path."""

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from terralist import constants as K
from terralist.functions.unicode import class_of, fold_accents, fold_to_ascii, let

# Whitespace where texts are cleaned: Unicode white space and the separators
# U+001C to U+001F.  Needs the (?U) flag.
SPACE = r"[\s\x1c-\x1f]"


def _text(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def trim_space(column) -> Column:
    """Strip Unicode whitespace from both ends."""
    return F.regexp_replace(_text(column).cast("string"), rf"(?U)^{SPACE}+|{SPACE}+$", "")


def clean_text(column) -> Column:
    """Text normalize: emoji to space, accents folded, upper, single spaces."""
    text = F.coalesce(_text(column).cast("string"), F.lit(""))
    emoji = K.PICTOGRAPHIC_RANGES + K.EMOJI_JOINERS
    text = F.upper(fold_accents(text, blank=emoji))
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def homologate(column, mapping=None) -> Column:
    """Canonical category in upper case; unmapped values stay as they are."""
    mapping = K.PROPERTY_TYPES if mapping is None else mapping
    value = _text(column)
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.upper(F.coalesce(F.try_element_at(table, value), value))


def development_id(column, rules=None) -> Column:
    """Development id from a listing URL; the first matching host decides."""
    url = _text(column).cast("string")
    result = F.lit(None).cast("string")
    for host, pattern in reversed(rules or K.DEVELOPMENT_URL_RULES):
        found = F.when(url.rlike(pattern), F.regexp_extract(url, pattern, 1))
        result = F.when(url.rlike(host), found).otherwise(result)
    return result


def is_development(property_type, description, year_built, url) -> Column:
    """Any sign of a new development; missing evidence counts as no."""
    signs = [
        _text(property_type).rlike("(?i)desarrollo"),
        _text(description).rlike(K.PRESALE_PATTERN),
        _text(year_built).try_cast("double") >= K.DEVELOPMENT_YEAR,
        _text(url).isNotNull(),
    ]
    signs = [F.coalesce(sign, F.lit(False)) for sign in signs]
    return signs[0] | signs[1] | signs[2] | signs[3]


def resolve_development_type(property_type, title, *, cascade=True) -> Column:
    """Replace DESARROLLO by what the title says it is.

    With ``cascade`` land wins over house and house over the default apartment.
    Without it every development becomes an apartment.
    """
    kind, title = _text(property_type), _text(title)
    resolved = F.lit("DEPARTAMENTO")
    if cascade:
        resolved = (
            F.when(title.rlike(K.LAND_PATTERN), "TERRENO")
            .when(title.rlike(K.HOUSE_PATTERN), "CASA")
            .otherwise(resolved)
        )
    return F.when(kind == "DESARROLLO", resolved).otherwise(kind)


def _any_of(words) -> str:
    return "|".join(re.escape(w) for w in words)


def contains_any(text: Column, words) -> Column:
    """True when one of the words is in the text; searching for each literal is
    much faster than one long alternation."""
    # A word that contains another word of the list adds nothing.
    needed = [w for w in words if not any(o != w and o in w for o in words)]
    return reduce(or_, [text.contains(w) for w in needed])


def is_auction(*columns) -> Column:
    """1 when any text has auction words and no presale words, else 0."""
    def flag(text):
        return contains_any(text, K.AUCTION_WORDS) & ~contains_any(text, K.AUCTION_VETO_WORDS)

    flags = [F.coalesce(flag(_text(c)), F.lit(False)) for c in columns]
    return reduce(or_, flags).cast("tinyint")


def first_number(column, *, all_commas=False) -> Column:
    """First signed decimal in a text, as double.

    Only the first comma is dropped before reading unless ``all_commas``.
    """
    text = _text(column).cast("string")
    if all_commas:
        text = F.regexp_replace(text, ",", "")
    else:
        text = F.regexp_replace(text, r"(?s)^([^,]*),", "$1")
    return F.regexp_substr(text, F.lit(r"-?\d+(?:\.\d+)?")).try_cast("double")


def digits_and_dots(column) -> Column:
    """Number made of every digit and dot in the text; null when unreadable."""
    kept = F.regexp_replace(_text(column).cast("string"), r"[^\d.]", "")
    return F.when(kept != "", kept).try_cast("double")


def range_midpoint(column) -> Column:
    """Midpoint of ``a-b``; otherwise the first unsigned number; else null."""
    text = trim_space(column)
    number = r"[0-9]+(?:\.[0-9]+)?"
    both = rf"^\s*({number})\s*-\s*({number})\s*$"
    middle = (
        F.regexp_extract(text, both, 1).try_cast("double")
        + F.regexp_extract(text, both, 2).try_cast("double")
    ) / 2.0
    single = F.regexp_substr(text, F.lit(number)).try_cast("double")
    return F.when(text.rlike(both), middle).otherwise(single)


def _blank(text: Column, flags: str, patterns) -> Column:
    """Each pattern to a space, in order.

    The longest word of a pattern has to be in the text for it to match, so
    the pattern only runs on the texts that have it.
    """
    def step(text, upper, pattern):
        word = max(re.findall("[A-Z]+", re.sub(r"\\.", " ", pattern)), key=len)
        blanked = flags + pattern.replace(r"\s", SPACE)
        return let(text, lambda t: F.when(
            upper.contains(word), F.regexp_replace(t, blanked, " ")
        ).otherwise(t))

    def steps(whole):
        # Blanking never joins two letters, so a word missing at the start
        # stays missing and one upper-case copy serves all steps.
        return let(
            F.upper(whole), lambda upper: reduce(lambda t, p: step(t, upper, p), patterns, whole)
        )

    return let(text, steps)


def remove_legal(column) -> Column:
    """Legal boilerplate to a space."""
    return _blank(_text(column), "(?isU)", K.LEGAL_PATTERNS)


def remove_codes(column) -> Column:
    """Internal codes to a space."""
    return _blank(_text(column), "(?iU)", K.CODE_PATTERNS)


def remove_marketing(column) -> Column:
    """Marketing phrases and runs of exclamation or question marks to a space."""
    phrases = "(?iu)" + _any_of(K.MARKETING_PHRASES)
    text = let(_text(column), lambda t: F.when(
        contains_any(F.upper(t), K.MARKETING_PHRASES), F.regexp_replace(t, phrases, " ")
    ).otherwise(t))
    return F.regexp_replace(F.regexp_replace(text, "[!¡]{2,}", " "), "[?¿]{2,}", " ")


def remove_special(column) -> Column:
    """Bullets, asterisk runs, line-edge asterisks and dash runs."""
    def asterisks(text):
        text = F.regexp_replace(text, r"\*{2,}", " ")
        # (?d): only the newline ends a line, so \r and others stay ordinary.
        text = F.regexp_replace(text, rf"(?mdU)^\*{SPACE}*", "")
        return F.regexp_replace(text, rf"(?mdU){SPACE}*\*$", "")

    text = F.translate(_text(column), K.BULLETS, " " * len(K.BULLETS))
    text = let(text, lambda t: F.when(t.contains("*"), asterisks(t)).otherwise(t))
    return F.regexp_replace(text, f"[{re.escape(K.DASHES)}]{{2,}}", " ")


def remove_stop_words(column, words=None) -> Column:
    """Drop stop words and one-character words; single spaces between the rest."""
    words = F.array(*[F.lit(w) for w in (words or K.STOP_WORDS)])
    parts = F.split(_text(column), f"(?U){SPACE}+")
    kept = F.filter(
        parts,
        lambda w: (F.length(w) > 1) & ~F.array_contains(words, F.lower(w)),
    )
    return F.array_join(kept, " ")


def clean_description(column, *, drop_stop_words=False) -> Column:
    """Description cleaner used before vectorizing texts."""
    text = F.coalesce(_text(column).cast("string"), F.lit(""))
    text = remove_special(remove_marketing(remove_codes(remove_legal(text))))
    text = F.regexp_replace(text, class_of(K.CLEANER_EMOJI_RANGES) + "+", " ")
    text = F.upper(fold_to_ascii(text))
    if drop_stop_words:
        text = remove_stop_words(text)
    text = F.regexp_replace(text, K.PUNCTUATION_CLASS, " ")
    return F.trim(F.regexp_replace(text, f"(?U){SPACE}+", " "))


def with_clean_description(
    df: DataFrame,
    *,
    column="description_clean",
    output="description_embeddings_clean",
    drop_stop_words=False,
    too_short=K.TOO_SHORT,
) -> DataFrame:
    """Cleaned text plus its quality columns."""
    cleaned = clean_description(column, drop_stop_words=drop_stop_words)
    original, clean = F.length(F.col(column)), F.length(F.col(output))
    return df.withColumn(output, cleaned).withColumns(
        {
            "original_length": original,
            "clean_length": clean,
            "is_empty": clean == 0,
            "is_too_short": clean < too_short,
            "reduction_ratio": F.try_divide(original - clean, original),
        }
    )
