"""What the contracts of this subpackage call a word, for Spark and for tasks."""

from pyspark.sql import functions as F

#: Fixed value: the white space that separates words, as a regex class body.
SPACE = r"\x20\x09-\x0D"
#: The same characters as a list, for trimming.
SPACE_CHARS = " \t\n\x0b\x0c\r"


def word_array(text):
    """Words of a text column; an empty array for null and for no words."""
    trimmed = F.trim(text, F.lit(SPACE_CHARS))
    empty = F.array().cast("array<string>")
    return F.when(F.length(trimmed) > 0, F.split(trimmed, f"[{SPACE}]+")).otherwise(empty)


def word_count(text):
    """Number of words of a text column, 0 for null, without building them."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")
