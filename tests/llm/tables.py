"""Small document tables with the awkward cases: NULLs in any column, empty,
blank and long texts, repeated rows, and extra columns with clashing names."""
from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "key string, size long, score double, part int, token long, id long, block int, component long, sequence_id long, toxic int")
OWN = 5

LONG = "one two three four five six seven eight nine ten " * 4000


def table(spark, rows):
    """rows: (doc_id, text, lang, source)"""
    clash = ("k", 1, 0.5, 2, 3, 4, 5, 6, 7, 1)
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), *clash) for i, t, lang, s in rows], SCHEMA)


def prose(seed: int, words: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 8))) for _ in range(words))


def awkward(seed: int = 0):
    """(doc_id, text, lang, source) rows with copies, near copies and every odd case."""
    rnd = random.Random(seed)
    rows = []
    for i in range(0, 120, 4):
        base = prose(seed * 1000 + i, rnd.randint(20, 120))
        words = base.split()
        near = words[:]
        near[rnd.randrange(len(near))] = "changed"
        rows += [(i, base, "en", "a"), (i + 1, base.upper(), "en", "b"), (i + 2, " ".join(near), "fr", "c"), (i + 3, prose(seed * 1000 + i + 1, 30), "de", "a")]
    rows += [(200, None, None, None), (201, "", "en", "a"), (202, " \t\n ", None, "d"), (203, "two words", "en", None), (204, "Two  WORDS", "en", None),
             (205, LONG, "en", "a"), (206, LONG + "end", "en", "a"), (None, "a row without an id here", "en", "a"), (207, "1234 !!", "es", "e")]
    return rows + [rows[0], rows[5], rows[5]]  # repeated rows
