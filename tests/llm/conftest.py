from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk string, score string, size string"


@pytest.fixture(scope="session")
def corpus(spark):
    """Makes documents of (doc_id, text[, source]) rows, with columns whose names could clash."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 7, "c", "x", "z") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and white texts, ties, repeated rows, one very long text, other alphabets."""
    rng = random.Random(3)
    words = ["the", "of", "and", "to", "Ärger", "ñandú", "x", "naïve", "AA", "bb,", "c.c", "été"]
    words += ["w%d" % i for i in range(60)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    shared, long = prose(45), prose(6000)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "two words"), (5, prose(19)), (6, prose(20)),
            (7, "a " * 70), (8, "a " * 90 + "b"), (9, "b " + "a " * 30), (10, "zz zz zz " * 30), (None, shared),
            (None, None), (11, shared), (12, shared.upper()), (13, prose(30) + "\n" + shared + "\t" + prose(8)),
            (14, "x" * 300), (15, "y" + "x" * 299), (16, "ab" * 100), (17, "ba" * 90), (20, long),
            (21, long[:9000] + " " + prose(50) + long[9000:]), (22, prose(15) + " " + shared[7:120] + prose(30))]
    rows += [(30 + i, prose(60)) for i in range(20)]
    copied = [text for _, text in rows if text and len(text) > 100]
    for i in range(40):
        a, b = rng.choice(copied), rng.choice(copied)
        x, y = rng.randrange(len(a)), rng.randrange(len(b))
        rows.append((60 + i, a[x:x + rng.randrange(20, 900)] + rng.choice(["", " ", "\n"]) + b[y:y + rng.randrange(20, 500)]))
    rows += [(60, rows[-40][1]), (61, "another text of the same id " + shared)]
    return rows
