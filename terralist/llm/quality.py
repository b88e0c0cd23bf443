"""Quality rules: a table of thresholds compiled into one Spark projection.

Everything is built-in DataFrame functions.  A document is read once and never
leaves its task, so there is no shuffle and no key that could be hot.

Defined results: a null or empty text has no words and fails the base rule;
repeated rows are judged one by one; an empty table gives an empty table; extra
columns are not read.  All work is in proportion to the text (sorting apart),
whatever its length.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from terralist.llm.batches import sheltered
from terralist.llm.words import SPACE, word_array

#: Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "with", "as", "on", "this", "be", "by",
    "der", "die", "und", "das", "den", "von", "ist", "mit", "ein", "eine", "nicht", "auf", "sich",
    "le", "les", "des", "et", "un", "une", "du", "est", "dans", "que", "pour", "avec", "qui",
    "de", "la", "el", "y", "los", "las", "del", "en", "una", "con", "por", "se",
)
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``low <= 100 * part / whole <= high``, in whole numbers; no whole passes."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None


#: Rules beyond the base ones.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 200, 2000),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 25),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 3, None),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", None, 30),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines", None, 30),
    Rule("bullet_line_ratio", "n_bullet_lines", "n_lines", None, 90),
)
BASE = (
    Rule("too_few_words", "n_words", "1", 100 * 20, None),
    Rule("repeated_windows", "n_repeat_words", "n_words", None, 30),
)


def passes(rule):
    """A rule as a condition that Spark and DuckDB read alike."""
    low = "" if rule.low is None else f"100 * {rule.part} >= {rule.low} * {rule.whole}"
    high = "" if rule.high is None else f"100 * {rule.part} <= {rule.high} * {rule.whole}"
    return "(" + " AND ".join(x for x in (low, high) if x) + ")"


def all_pass(rules):
    return " AND ".join(map(passes, rules)) or "true"


def window_hashes(words):
    """One hash per run of ``WINDOW`` words, in order."""
    last = F.size(words) - (WINDOW - 1)
    none = F.array().cast("array<bigint>")
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))).otherwise(none)


def repeated_starts(hashes):
    """Sorted starts of the windows whose hash occurs twice or more.

    Sorting brings equal windows together; texts without any, the great
    majority, are told by their number of distinct hashes and not sorted.
    """
    none = F.array().cast("array<int>")
    ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def neighbours(s):
        def repeated(x, j):
            same = lambda y: F.coalesce(y["h"] == x["h"], F.lit(False))
            return same(F.get(s, j - 1)) | same(F.get(s, j + 1))

        return F.transform(F.filter(s, repeated), lambda x: x["i"])

    # transform over a one-element array names the sorted array, so that it is sorted once.
    starts = F.transform(F.array(ranked), neighbours)[0]
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(starts)).otherwise(none)


def covered_words(starts):
    """Words inside the windows at sorted ``starts``, each counted once."""
    steps = F.transform(starts, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - p, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)


@sheltered("_words", "_lines", "_hashes", "_starts")
def measures(docs, text="text"):
    """``docs`` with the columns that the rules compare, added in a few projections."""
    raw = F.coalesce(F.col(text), F.lit(""))
    has_word = f"[^{SPACE}]"
    count = lambda lines, pattern: F.size(F.filter(lines, lambda x: x.rlike(pattern))).cast("long")
    stops = sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)})
    step = docs.withColumns({
        "_words": word_array(raw),
        "_lines": F.filter(F.split(raw, "\n"), lambda x: x.rlike(has_word)),
        "word_chars": (F.length(raw) - F.regexp_count(raw, F.lit(f"[{SPACE}]"))).cast("long"),
        "n_symbols": F.regexp_count(raw, F.lit(SYMBOLS)).cast("long"),
    })
    step = step.withColumn("_hashes", window_hashes(F.col("_words")))
    step = step.withColumn("_starts", repeated_starts(F.col("_hashes")))
    return step.withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_stop_words": F.size(F.filter("_words", lambda w: w.isin(stops))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_ellipsis_lines": count(F.col("_lines"), r"(\.\.\.|…)[\x20\x09-\x0D]*$"),
        "n_bullet_lines": count(F.col("_lines"), r"^[\x20\x09-\x0D]*[-*•]"),
        "n_repeat_words": covered_words(F.col("_starts")),
    }).drop("_words", "_lines", "_hashes", "_starts")


def quality(docs, text="text", rules=RULES, base=BASE):
    """Measures and verdicts of every document.

    Adds the measures, ``base_failed`` (a base rule fails), ``failed`` (names of
    all failed rules, in table order) and ``kept``.
    """
    named = [F.when(~F.expr(passes(r)), F.lit(r.name)) for r in (*base, *rules)]
    return measures(docs, text).withColumns({
        "base_failed": ~F.expr(all_pass(base)),
        "failed": F.array_compact(F.array(*named)),
    }).withColumn("kept", F.size("failed") == 0)


def quality_sql(table="documents", key="doc_id", text="text", rules=RULES, base=BASE):
    """The same in DuckDB's SQL, keyed by ``key``."""
    stops = ", ".join(f"'{w}'" for w in sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)}))
    return rf"""
WITH d AS (SELECT {key}, coalesce({text}, '') AS t FROM {table}),
w AS (SELECT {key}, t, list_filter(regexp_split_to_array(t, '[{SPACE}]+'), lambda x: x <> '') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')) AS lines FROM d),
g AS (SELECT {key}, len(words) AS n, unnest(range(1, len(words) - {WINDOW} + 2)) AS p, words FROM w WHERE len(words) >= {WINDOW}),
h AS (SELECT {key}, n, p, array_to_string(words[p : p + {WINDOW - 1}], ' ') AS g FROM g),
r AS (SELECT {key}, p, count(*) OVER (PARTITION BY {key}, g) AS c FROM h),
c AS (SELECT {key}, least({WINDOW}, coalesce(lead(p) OVER (PARTITION BY {key} ORDER BY p) - p, {WINDOW})) AS k FROM r WHERE c > 1),
s AS (SELECT {key}, sum(k) AS n_repeat_words FROM c GROUP BY {key}),
m AS (SELECT {key}, len(words) AS n_words,
             length(t) - length(regexp_replace(t, '[^{SPACE}]', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS n_symbols,
             len(list_filter(words, lambda x: x IN ({stops}))) AS n_stop_words,
             len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[{SPACE}]*$'))) AS n_ellipsis_lines,
             len(list_filter(lines, lambda x: regexp_matches(x, '^[{SPACE}]*[-*•]'))) AS n_bullet_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM w LEFT JOIN s USING ({key}))
SELECT {key}, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, NOT ({all_pass(base)}) AS base_failed,
       {all_pass((*base, *rules))} AS kept
FROM m"""
