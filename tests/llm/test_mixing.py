"""Water-filling against a plain loop, and the draw against a sort of each source."""

import hashlib
import re

import pytest

from helpers import TEXTS, documents
from tidegate.llm.mixing import mix_sources, water_fill


def fill(sizes, weights, cap=3):
    """Clamp, share what is left, and again."""
    total, clamped = sum(sizes.values()), set()
    while True:
        free = {s for s in sizes if s not in clamped}
        level = (total - sum(cap * sizes[s] for s in clamped)) / (sum(weights[s] for s in free) or 1)
        above = {s for s in free if weights[s] * level > cap * sizes[s]}
        if not above:
            return {s: cap * sizes[s] if s in clamped else weights[s] * level for s in sizes}
        clamped |= above


def weights_of(sources):
    return {s: k % 3 + 1 for k, s in enumerate(sorted(sources, key=lambda s: (s is None, s or "")))}


def brute_force(rows):
    """rows (doc_id, text, source) → sorted (doc_id, size, source_size, target, taken)."""
    sized = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s, t) for i, t, s in rows]
    sizes = {s: sum(n for _, n, other, _ in sized if other == s) for s in {r[2] for r in sized}}
    targets, out = fill(sizes, weights_of(sizes)), []
    for source, size in sizes.items():
        target = targets[source]
        whole = int(target) // size if size else 0
        room, upto = int(target) - whole * size, 0
        draws = [(hashlib.md5(f"mix-1:{'' if i is None else i}:{t or ''}".encode()).hexdigest(), n, i) for i, n, s, t in sized if s == source]
        for _, n, i in sorted(draws, key=lambda d: (d[0], d[1])):
            extra = int(room > 0 and 2 * upto + n <= 2 * room)
            upto += n
            out.append((i, n, size, target, n * (whole + extra)))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "size", "source_size", "target", "taken").collect()), key=str)


def near(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:3] == b[:3] and a[4] == b[4] and a[3] == pytest.approx(b[3], rel=1e-12)


def table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name in ("key", "size", "draw", "target", "room", "whole", "extra", "digits", "left", "__n"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df


def test_awkward_rows(spark):
    sources = ["b", "a", None, "", "\x00", "é", "Z", "日本", "a"]
    rows = [(i, t, sources[k % len(sources)]) for k, (i, t) in enumerate(TEXTS * 2)]
    near(result(mix_sources(spark, table(spark, rows))), brute_force(rows))


def test_targets_are_met(spark):
    """One source holds most rows, one is so small that it is clamped, one has no words."""
    rows = [(i, "w " * (i % 40), "web") for i in range(3000)] + [(10_000 + i, "x y z", "tiny") for i in range(20)]
    rows += [(20_000 + i, "k " * (1 + i % 7), "books") for i in range(500)] + [(30_000, "", "void"), (30_001, None, "void")]
    got = mix_sources(spark, table(spark, rows))
    near(result(got), brute_force(rows))
    for r in got.groupBy("source", "target").agg({"taken": "sum", "size": "max", "source_size": "max"}).collect():
        assert abs(r["sum(taken)"] - r["target"]) <= r["max(size)"] / 2 + 1
    assert all(r["taken"] <= 3 * r["size"] for r in got.collect())
    assert result(mix_sources(spark, table(spark, rows[::-1]))) == result(got)


def test_another_seed_takes_others(spark):
    rows = [(i, "w " * 10, "web" if i % 2 else "books") for i in range(400)]
    first, second = (mix_sources(spark, table(spark, rows), seed=s) for s in ("a", "b"))
    assert {r["doc_id"]: r["taken"] for r in first.collect()} != {r["doc_id"]: r["taken"] for r in second.collect()}


def test_filling_goes_on_until_feasible(spark):
    """Each clamped source pushes the next one above its cap."""
    sizes = {f"s{k:02}": 4 ** k for k in range(8)}
    weights = {s: 5.0 for s in sizes}
    given = spark.createDataFrame([(s, n, weights[s]) for s, n in sizes.items()], "source string, source_size long, weight double")
    got = {r["source"]: r["target"] for r in water_fill(given).collect()}
    assert got == pytest.approx(fill(sizes, weights)) and sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_empty_table(spark):
    assert mix_sources(spark, table(spark, [])).collect() == []
    assert documents(spark, []).count() == 0
