"""The prefix trie, its tour and its subtree sums, against a trie built in memory."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidegate.llm import ordering
from tidegate.llm.prefix_trie import list_ranks, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def table(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("depth", "n_convs", "parent", "nth", "id", "next", "digest", "place"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df


def turn_key(row):
    _, turn, role, text = row
    role, text = role or "", text or ""
    return turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()


def brute_force(rows):
    turns = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=turn_key):
        turns[row[0]].append((row[2] or "", row[3] or ""))
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(turns.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out, clock = [], 0
    todo, entered, sums = [((), False)] if members else [], {}, {}
    while todo:
        node, leaving = todo.pop()
        if not leaving:
            entered[node], clock = clock, clock + 1
            todo.append((node, True))
            todo += [(c, False) for c in sorted(children[node], key=lambda c: min(members[c]), reverse=True)]
            continue
        own = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        leaves = sum(sums[c][0] for c in children[node]) or 1
        sums[node] = leaves, own + sum(sums[c][1] for c in children[node])
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                    len(children[node]), *sums[node], digest, entered[node], clock))
        clock += 1
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


AWKWARD = [(0, 0, "user", "a"), (0, 1, "bot", "é日"), (0, 2, "user", None), (3, None, None, "first"), (3, 0, "user", "a"),
           (3, 0, "user", "b"), (3, 0, "user", "a"), (7, 0, "user", "only one"), (10, 5, "u:1", "x"), (10, 6, "u", "1:x"),
           (11, 0, "user", ""), (12, 0, "user", ""), (None, 0, "user", "nobody's"), (-3, 0, "user", "a"), (-5, 0, "user", "a"),
           (2 ** 40, 0, "user", "a"), (2 ** 40, 1, "bot", "long " * 20_000)]


def some_rows(seed, n=60):
    pick = random.Random(seed)
    rows = []
    for c in range(n):
        rows += [(c, t, "user" if t % 2 == 0 else "bot", pick.choice("ab" if t < 4 else "abc") * (t + 1)) for t in range(pick.randrange(0, 12))]
    copies = [(1000 + i, t, r, x) for i in range(25) for _, t, r, x in rows if _ == 5]
    pick.shuffle(rows)
    return rows + copies


@pytest.mark.parametrize("chunk", [4096, 3])
def test_against_a_trie_in_memory(spark, monkeypatch, chunk):
    """Short chunks make paths, conversations and lists of members cross many of them."""
    from tidegate.llm import prefix_trie as module

    monkeypatch.setattr(ordering, "CHUNK", chunk)
    monkeypatch.setattr(module, "CHUNK", chunk)
    rows = some_rows(chunk) + AWKWARD + [(5000, t, "user", str(t)) for t in range(40)]
    assert result(prefix_trie(spark, table(spark, rows))) == brute_force(rows)


def test_one_conversation_and_none(spark):
    assert result(prefix_trie(spark, table(spark, [(4, 0, "user", "x")]))) == brute_force([(4, 0, "user", "x")])
    assert result(prefix_trie(spark, table(spark, []))) == []
    assert result(prefix_trie(spark, table(spark, [(None, 0, "user", "x")]))) == []


def test_list_ranks(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    rows = [(a, b, 1, a, 2 * a) for a, b in zip(order, order[1:] + [None])]
    ranks = list_ranks(spark, spark.createDataFrame(rows, "id long, next long, length long, leaves long, saved long"), "ranks")
    behind, want = 0, {}
    for k, a in enumerate(reversed(order)):
        behind += a
        want[a] = (k + 1, behind, 2 * behind)
    assert {r["id"]: (r["length"], r["leaves"], r["saved"]) for r in ranks.collect()} == want


def test_numbered_rows_keep_the_order(spark):
    rows = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 1000).alias("k"))
    got = [r["k"] for r in ordering.numbered(spark, rows, [F.col("k").desc()], "n", "test").orderBy("n").collect()]
    assert got == sorted(got, reverse=True) and len(got) == 5000
    assert ordering.numbered(spark, rows, [F.col("k").desc()], "n", "test").agg(F.countDistinct("n"), F.max("n")).first() == (5000, 4999)
