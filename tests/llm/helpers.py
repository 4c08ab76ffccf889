"""Small awkward tables: nulls, empty and long texts, repeated rows, ties, and columns with clashing names."""

import random

EXTRA = "block long, size string, copies int, _row int, kind string, target double, _id string"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA


def documents(spark, rows):
    """rows: (doc_id, text, source)."""
    full = [(i, t, "en", s, len(t or ""), 7, "s", 3, 4, "k", 0.5, "x") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def sentence(rng, n):
    return " ".join("".join(rng.choice(["an", "er", "th", "ou", "ing", "le", "on"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def awkward(seed=0, n=60):
    """Rows with exact and near copies, shared passages, repeated rows, nulls, empty and very long texts."""
    rng = random.Random(seed)
    passage = sentence(rng, 30)
    rows = []
    for i in range(n):
        text = sentence(rng, rng.randint(1, 120))
        if i % 5 == 1:
            text = text[: len(text) // 2] + " " + passage + " " + text[len(text) // 2 :]
        if i % 7 == 3 and rows and rows[-1][1]:
            words = rows[-1][1].split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        if i % 11 == 5 and rows:
            text = rows[-2][1]
        rows.append((i * 3, text, rng.choice(["a", "b", "é", None])))
    rows += [(1000, None, "a"), (1001, "", None), (1002, "   \n\t ", "b"), (1003, "one", "b"), (1004, "a b c d", "b"), (1005, "A b C d", "b"), (1006, "x" * 70_000, "a"), (1007, "ab" * 40_000, "a")]
    rows += [(1008, sentence(rng, 9000), "a"), (1009, "é" * 300 + passage, "é"), rows[0], rows[0]]
    return rows
