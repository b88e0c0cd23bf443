"""Texts and rows that the tests share."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use for what they add.
CLASHES = ("n_tokens", "ids", "score", "size", "target", "taken", "kept", "spans", "entropy", "_key", "component_id")


def prose(seed, words, alphabet=("the", "and", "of", "river", "stone", "cloud", "was", "over", "under", "green", "house", "walks")):
    rng = random.Random(seed)
    return " ".join(rng.choice(alphabet) + rng.choice(["", "", "s", ",", "."]) for _ in range(words))


def odd_rows():
    base = prose(1, 60)
    rows = [
        (1, base, "en", "a", 1), (1, base, "en", "a", 1), (2, base, "en", "b", 2), (3, base + " more", None, None, None),
        (4, None, "en", "a", None), (5, "", "de", "b", 0), (6, " \n\t ", None, "c", 4), (7, "Das ist schön und gut " * 8, "de", "c", 5),
        (None, "le chat et la maison " * 6, "fr", None, None), (None, None, None, None, None), (8, "a", "en", "a", 1),
        (9, "😀é漢 " * 30, "de", "d", 9), (10, prose(2, 3), "en", "d", 1), (11, base.upper(), "en", "a", 7),
        (12, "x" * 5000, "en", "a", 5000), (13, "one two three", "en", "a", 3), (14, "one two three", "en", "b", 3),
        (15, prose(3, 20_000), "en", "a", 99), (16, "Line.\nLine.\nLine.\n" * 9, "en", "a", 1), (17, "\x00\x1f |$$ %%", "en", "a", 1),
    ]
    return rows
