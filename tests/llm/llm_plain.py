"""Plain helpers and odd rows shared by the tests of this folder."""

import random
import re

DOCS_DDL = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def lower(text):
    """A-Z only."""
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_rows():
    """Nulls in every column, empty, blank and long texts, ties, repeated rows,
    equal and nearly equal texts, accents, control characters."""
    rng = random.Random(3)
    long = prose(rng, 30_000, 5000)
    base = prose(rng, 120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", None, None, 4), (None, "no id here", "en", "a", 10),
        (4, long, "en", "b", len(long)), (5, base, "en", "b", 1), (6, base, "de", "a", 1), (6, base, "de", "a", 1),
        (7, base.replace(" ", "\n"), "en", "b", 1), (8, " ".join(near), "en", "c", 1), (9, "one two", "en", "c", 7),
        (10, "ONE two", "en", "c", 7), (11, "Über straße école ñandú", "es", "é", 3), (12, "a\x00b c\x1fd", "en", "Z", 3),
        (13, "MIT License applies. Apache license and the GENERAL  public\nLicense; mit license", "en", "c", 3),
        (None, None, None, None, None), (None, base, "en", "b", 1),
    ]
    rows += [(100 + i, prose(rng, rng.randrange(5, 300)), "en", rng.choice("abc"), i) for i in range(40)]
    rows += [(200 + i, "the same line of a third of all rows, with enough words to be kept by a rule", "en", "a", i) for i in range(25)]
    return rows
