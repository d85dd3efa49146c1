"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import re

LONG = " ".join(f"word{i % 977}x{i}" for i in range(20_000))

TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog near the river bank today"),
    (2, "the quick brown fox jumps over the lazy dog near the river bank today"),
    (3, "The QUICK brown fox jumps over the lazy dog near the river bank today again"),
    (4, ""), (5, None), (6, "   \n\t "), (7, "one two"), (8, "One  TWO"), (9, LONG), (10, LONG + " tail"),
    (11, "é ß 日本語 don't stop\n\nsecond  part 12.5% | x"), (12, "a" * 5000), (13, "<|endoftext|> special <s>"),
    (None, "no id here at all, really none"), (14, "\x00\x1c odd bytes \U0001F642"), (7, "one two"),
]
SCHEMA = "doc_id long, text string"


def documents(spark, rows=TEXTS):
    """With further columns whose names the operators use themselves."""
    names = ("n", "band", "score", "component_id", "digest", "words", "bucket", "slot", "item_id", "toxic", "__id")
    df = spark.createDataFrame(list(rows), SCHEMA)
    for name in names:
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def near_duplicate_groups(rows):
    """Brute force over all pairs: {doc_id: smallest doc_id reachable}; rows of one id are one document."""
    ids = sorted({i for i, _ in rows if i is not None})
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return {i: find(i) for i in ids}
