"""Small documents and vectors with every awkward case, and helpers."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, v int, tid string, copies int, _key int"


def documents(spark, texts, sources=None):
    """Rows with extra columns whose names clash with those the operators use inside."""
    rows = [(i, t, None, (sources or {}).get(i, "s"), None if t is None else len(t), "x", 7, "y", 9, 3)
            for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_texts():
    """(doc_id, text): null and empty texts, blanks only, one word, long texts, copies, near copies,
    rows that repeat as a whole, one id with two texts, rows without an id."""
    rng = random.Random(5)
    base = words(rng, 120)
    long = words(rng, 30_000, 3000)
    passage = words(rng, 80, 5000)
    near = base.split()
    near[60] = "changed"
    out = [(0, None), (1, ""), (2, " \t\n "), (3, "Word"), (4, base), (5, base), (6, " ".join(near)), (7, long), (8, long + " end"),
           (9, words(rng, 50) + " " + passage + " " + words(rng, 50)), (10, words(rng, 40) + " " + passage),
           (11, "A" * 700), (12, "á é ▁x  y <s> <|endoftext|> \U0001F600 中文"), (13, "x\x00y \x0b z\x1c"),
           (14, base.upper()), (15, "same row"), (15, "same row"), (16, "one id"), (16, "two texts"), (None, base), (None, "no id"),
           (17, "word"), (18, "w1 w2"), (19, "w1 w2"), (20, "'s don't it's ½ 12345 café ǅ İ"), (21, "b" * 150 + "A" * 300)]
    out += [(100 + i, " ".join(["hot", "line", "here"] * 30) + f" {i}") for i in range(12)]
    return out
