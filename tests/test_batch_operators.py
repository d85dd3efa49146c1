import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidegate.operators import scd
from tidegate.operators.changes import append_only, dedup_within_commit
from tidegate.operators.ordered import heavy_or_none, running_total_before, with_next, with_previous
from tidegate.operators.quality import expect_all_or_drop, expectation_report
from tidegate.operators.temporal import as_of_version_join
from tidegate.plans import gold

T0 = dt.datetime(2026, 1, 1)


def at(n):
    """n-th point in time; eight hours apart, so that several points share a day."""
    return None if n is None else T0 + dt.timedelta(hours=8 * n)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# ---- expectations and change feeds

RULES = {"quantity": "quantity > 0", "amount": "amount > 0", "order_date": "order_date is not null"}


def test_expectations(spark):
    data = [(1, 1, 5.0, "d"), (2, 0, 5.0, "d"), (3, 1, -5.0, "d"), (4, 1, 5.0, None), (5, None, 5.0, "d")]
    df = spark.createDataFrame(data, "id int, quantity int, amount double, order_date string")
    assert rows(expect_all_or_drop(df, RULES), "id") == [(1,)]
    assert rows(expectation_report(df, RULES), "rule", "passed", "failed") == [
        ("amount", 4, 1), ("order_date", 4, 1), ("quantity", 3, 2)]
    empty = rows(expectation_report(df.limit(0), RULES), "rule", "passed", "failed")
    assert empty == [("amount", 0, 0), ("order_date", 0, 0), ("quantity", 0, 0)]


def test_append_only(spark):
    data = [(1, "insert", 1), (2, "insert", 1), (3, "insert", 2), (1, "update_postimage", 2), (4, "insert", 3)]
    df = spark.createDataFrame(data, "id int, _change_type string, _commit_version bigint")
    assert rows(append_only(df), "id") == [(1,), (2,), (4,)]
    assert rows(append_only(df, "row"), "id") == [(1,), (2,), (3,), (4,)]
    with pytest.raises(ValueError):
        append_only(df, "file")


def test_copies_are_dropped_inside_a_commit_only(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (1, "a", 2), (1, None, 2), (1, None, 2)],
                               "id int, v string, _commit_version bigint")
    assert rows(dedup_within_commit(df), "*") == [(1, "a", 1), (1, "a", 2), (1, None, 2)]


# ---- type 1 and type 2

def changes(spark, data, schema="id string, v int, seq int"):
    return spark.createDataFrame(data, schema)


def test_scd1_takes_the_latest(spark):
    df = changes(spark, [("1", 10, 1), ("1", 30, 3), ("1", 20, 2), ("2", 40, 1), (None, 50, 9)])
    assert rows(scd.scd1(df, ["id"], "seq", ["seq"]), "*") == [("1", 30), ("2", 40)]


def test_scd1_ignores_preimages_and_deletes_on_request(spark):
    data = [("1", 1, 1, "insert"), ("1", 9, 5, "update_preimage"), ("2", 2, 1, "insert"), ("2", 2, 2, "delete"),
            ("3", 3, 2, "delete"), ("3", 4, 3, "insert")]
    df = changes(spark, data, "id string, v int, seq int, _change_type string")
    deletes = F.col("_change_type") == "delete"
    kept = ["seq", "_change_type"]
    assert rows(scd.scd1(df, ["id"], "seq", kept), "*") == [("1", 1), ("2", 2), ("3", 4)]
    assert rows(scd.scd1(df, ["id"], "seq", kept, deletes), "*") == [("1", 1), ("3", 4)]


def test_scd2_collapses_unchanged_and_breaks_ties(spark):
    df = changes(spark, [("A", 10, 1), ("A", 10, 2), ("A", 12, 3), ("A", 11, 3), ("B", 7, 2)])
    got = scd.scd2(df, ["id"], "seq", ["seq"])
    assert rows(got, "id", "v", scd.START_AT, scd.END_AT) == [("A", 10, 1, 3), ("A", 12, 3, None), ("B", 7, 2, None)]
    assert rows(scd.current(got), "id", "v") == [("A", 12), ("B", 7)]
    assert rows(scd.with_first_start(got, "id"), "id", "v", "min_start") == [("A", 10, 1), ("A", 12, 1), ("B", 7, 2)]
    full = scd.scd2(df, ["id"], "seq", ["seq"], collapse_unchanged=False)
    assert rows(full, "id", "v", scd.START_AT, scd.END_AT) == [
        ("A", 10, 1, 2), ("A", 10, 2, 3), ("A", 12, 3, None), ("B", 7, 2, None)]


def test_scd2_delete_closes_the_interval(spark):
    data = [("A", 1, 1, "insert"), ("A", 1, 3, "delete"), ("A", 1, 5, "insert")]
    df = changes(spark, data, "id string, v int, seq int, _change_type string")
    got = scd.scd2(df, ["id"], "seq", ["seq", "_change_type"], F.col("_change_type") == "delete")
    assert rows(got, "v", scd.START_AT, scd.END_AT) == [(1, 1, 3), (1, 5, None)]


change_lists = st.lists(st.tuples(st.sampled_from("ABC"), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 12)),
                        min_size=1, max_size=40)


def model_scd2(data):
    """The rules, one key at a time."""
    out = []
    for key in {k for k, _, _ in data}:
        best = {}
        for k, v, s in data:
            if k == key and (s not in best or best[s] is None or (v is not None and v > best[s])):
                best[s] = v
        kept = []
        for s in sorted(best):
            if not kept or kept[-1][1] != best[s]:
                kept.append((s, best[s]))
        ends = [s for s, _ in kept[1:]] + [None]
        out += [(key, v, s, e) for (s, v), e in zip(kept, ends)]
    return sorted(out, key=str)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(change_lists)
def test_scd2_matches_the_model_for_ordinary_and_heavy_keys(spark, data):
    df = changes(spark, [(k, v, s) for k, v, s in data])
    timed = df.withColumn("seq", F.timestamp_seconds(F.col("seq") * 28800))
    want = model_scd2(data)
    for limit in (1000, 3, 0):
        got = scd.scd2(timed, ["id"], "seq", ["seq"], max_group_rows=limit)
        seconds = [(F.unix_timestamp(c) / 28800).cast("int").alias(c) for c in (scd.START_AT, scd.END_AT)]
        assert rows(got.select("id", "v", *seconds), "*") == want
        shuffled = list(data)
        random.Random(limit).shuffle(shuffled)
        latest = scd.scd1(changes(spark, shuffled), ["id"], "seq", ["seq"])
        assert rows(latest, "id", "v") == sorted(((k, v) for k, v, _, e in want if e is None), key=str)


def test_neighbours_across_chunks(spark):
    data = [("hot", n, None if n % 4 == 0 else n * 10) for n in range(25)] + [("cold", 3, 1), ("cold", 9, 2)]
    df = spark.createDataFrame([(k, at(n), n, v) for k, n, v in data], "k string, t timestamp, n int, v int")
    heavy = heavy_or_none(df, ["k"], 5)
    assert [r.k for r in heavy.collect()] == ["hot"]
    assert heavy_or_none(df, ["k"], 25) is None
    for step in (with_previous, with_next):
        plain = rows(step(df, ["k"], "t", F.col("v"), "x"), "k", "n", "x")
        assert rows(step(df, ["k"], "t", F.col("v"), "x", heavy), "k", "n", "x") == plain


def test_running_total_before(spark):
    amounts = [(at(n % 11), n) for n in range(50)] + [(None, 1000)]
    points = [at(0), at(3), at(11), at(20), at(3), None]
    got = running_total_before(spark.createDataFrame(amounts, "t timestamp, a bigint"),
                               spark.createDataFrame([(p,) for p in points], "t timestamp"), "t", "a")
    want = {p: sum(a for t, a in amounts if t and t < p) for p in points if p}
    assert {r.t: r.total_before for r in got.collect()} == want
    assert {r.t: r.rows_before > 0 for r in got.collect()} == {p: v > 0 or p > at(0) for p, v in want.items()}


# ---- temporal join

def versions(spark, data):
    return spark.createDataFrame([(p, price, at(s), at(e)) for p, price, s, e in data],
                                 "pid string, price int, __START_AT timestamp, __END_AT timestamp")


def facts(spark, data):
    return spark.createDataFrame([(i, p, at(t)) for i, p, t in data], "id int, pid string, t timestamp")


def test_temporal_join_golden(spark):
    v = versions(spark, [("A", 10, 10, 20), ("A", 20, 20, None), ("B", 3, 3, None)])
    f = facts(spark, [(1, "A", 5), (2, "A", 15), (3, "B", 1), (4, "A", None), (5, None, 15), (6, "C", 15)])
    for probe, limit in ((100, 100), (0, 100), (0, 1), (100, 1)):
        options = dict(max_versions_to_probe=probe, max_group_rows=limit)
        assert rows(as_of_version_join(f, v, "pid", "t", **options), "id", "price") == [(1, 10), (2, 10), (3, 3)]
        assert rows(as_of_version_join(f, v, "pid", "t", "drop", **options), "id", "price") == [(2, 10)]


def test_temporal_join_rejects_shared_columns(spark):
    v = versions(spark, [("A", 10, 10, 20)])
    with pytest.raises(ValueError):
        as_of_version_join(facts(spark, []).withColumn("price", F.lit(1)), v, "pid", "t")


@pytest.mark.parametrize("before_first", ["earliest", "drop"])
def test_temporal_join_against_brute_force(spark, before_first):
    draw = random.Random(7)
    spans = []
    for product in "ABC":
        starts = sorted(draw.sample(range(5, 60), 12))
        ends = starts[1:] + [None]
        ends[4] -= 1 if ends[4] - starts[4] > 1 else 0  # a gap, as a delete leaves
        spans += [(product, i, s, e) for i, (s, e) in enumerate(zip(starts, ends))]
    sold = [(i, draw.choice("AAAABCD"), draw.randrange(0, 70)) for i in range(300)]
    first = {p: min(s for q, _, s, _ in spans if q == p) for p in "ABC"}
    want = sorted((i, price) for i, p, t in sold for q, price, s, e in spans if p == q and (
        (s <= t and (e is None or t < e)) or (before_first == "earliest" and t < first[p] and s == first[p])))
    for probe, limit in ((100, 1000), (0, 1000), (0, 20)):
        got = as_of_version_join(facts(spark, sold), versions(spark, spans), "pid", "t", before_first,
                                 max_versions_to_probe=probe, max_group_rows=limit)
        assert sorted(rows(got, "id", "price")) == want


# ---- price and demand

def history(spark, spans):
    return spark.createDataFrame([(p, "cat" + p, float(price), at(s), at(e)) for p, price, s, e in spans],
                                 "product_id string, category string, price double, "
                                 "__START_AT timestamp, __END_AT timestamp")


def sales(spark, sold):
    return spark.createDataFrame([(p, q, at(t)) for p, q, t in sold],
                                 "product_id string, quantity int, Order_date timestamp")


def test_price_changes(spark):
    spans = [("A", 10, 1, 2), ("A", 12, 2, 3), ("A", 12, 3, 4), ("A", 9, 4, None)]
    got = gold.price_changes(history(spark, spans)).orderBy("__START_AT").collect()
    assert [(r.prev_price, r.price_direction) for r in got] == [(10, "SAME"), (10, "UP"), (12, "SAME"), (12, "DOWN")]


def brute_force_demand(spans, sold, same_product):
    first = {p: min(s for q, _, s, _ in spans if q == p) for p, *_ in spans}
    out = []
    for product in first:
        prev_price = prev_demand = None
        for p, price, s, e in sorted((x for x in spans if x[0] == product), key=lambda x: x[2]):
            hits = [q for o, q, t in sold if (o == p and s <= t and (e is None or t < e))
                    or ((o == p or not same_product) and t < first[p] and s == first[p])]
            before, prev_price = price if prev_price is None else prev_price, price
            if hits:
                demand = sum(hits)
                previous, prev_demand = demand if prev_demand is None else prev_demand, demand
                name = lambda a, b: "UP" if a > b else "DOWN" if a < b else "SAME"
                out.append(("cat" + p, float(before), float(price), name(price, before), previous, demand,
                            name(demand, previous)))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [1000, 8])
def test_price_demand_against_brute_force(spark, limit):
    draw = random.Random(3)
    spans = []
    for product in "ABCD":
        starts = sorted(draw.sample(range(10, 60), 10))
        spans += [(product, draw.randrange(5, 9), s, e) for s, e in zip(starts, starts[1:] + [None])]
    sold = [(draw.choice("AAAABCDE"), draw.randrange(1, 9), draw.randrange(0, 70)) for _ in range(60)]
    for probe in (100, 0):
        got = gold.price_demand_analysis(sales(spark, sold), history(spark, spans), max_versions_to_probe=probe,
                                         max_group_rows=limit)
        assert rows(got, "*") == brute_force_demand(spans, sold, same_product=True)
        got = gold.price_demand_any_product_fallback(sales(spark, sold), history(spark, spans),
                                                     max_versions_to_probe=probe, max_group_rows=limit)
        assert rows(got, "*") == brute_force_demand(spans, sold, same_product=False)


def test_fallback_without_product_golden(spark):
    """An early sale of B also counts for the first version of A, which starts later."""
    spans = [("A", 10, 10, 20), ("A", 20, 20, None), ("B", 3, 3, None)]
    sold = [("A", 1, 5), ("A", 2, 15), ("B", 4, 1)]
    got = gold.price_demand_any_product_fallback(sales(spark, sold), history(spark, spans))
    assert [(r.category, r.current_demand) for r in got.collect()] == [("catA", 7), ("catB", 4)]


def test_price_demand_is_sorted_by_category(spark):
    spans = [(p, n, n, n + 1) for p in "CAB" for n in range(4)]
    sold = [(p, 1, n) for p in "CAB" for n in range(4)]
    got = [r.category for r in gold.price_demand_analysis(sales(spark, sold), history(spark, spans)).collect()]
    assert got == sorted(got) and len(got) == 12


# ---- one answer on every branch

def test_null_sequences_and_text_sequences_on_both_branches(spark):
    changes = spark.createDataFrame([(1, None, 1), (1, 1, 1), (1, 200000, 2), (2, None, 5)], "k int, seq int, v int")
    plain, heavy = (rows(scd.scd2(changes, ["k"], "seq", [], max_group_rows=m), "*") for m in (10, 1))
    assert plain == heavy and len(plain) == 2
    text = changes.withColumn("seq", F.col("seq").cast("string"))
    for most in (10, 1):
        try:
            scd.scd2(text, ["k"], "seq", [], max_group_rows=most)
        except TypeError:
            continue
        raise AssertionError("a text sequence was taken")


def test_previous_value_across_a_chunk_of_null_orders(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (1, 300000, "c")], "k int, o int, v string")
    heavy = spark.createDataFrame([(1,)], "k int")
    plain, chunked = (sorted((r.v, r.p and r.p.value) for r in with_previous(df, ["k"], "o", F.col("v"), "p", h).collect())
                      for h in (None, heavy))
    assert plain == chunked == [("a", None), ("b", "a"), ("c", "b")]


def test_a_version_without_start_never_matches(spark):
    versions = spark.sql("""SELECT * FROM VALUES (1, CAST(NULL AS TIMESTAMP), TIMESTAMP'2024-02-01', 9),
        (1, TIMESTAMP'2024-02-01', CAST(NULL AS TIMESTAMP), 10) AS t(k, __START_AT, __END_AT, price)""")
    facts = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP'2024-01-05', 'x'), (1, TIMESTAMP'2024-02-05', 'y') AS t(k, at, f)")
    for before, want in (("drop", [("y", 10)]), ("earliest", [("x", 10), ("y", 10)])):
        for probe, most in ((64, 100), (0, 100), (0, 1)):
            got = as_of_version_join(facts, versions, "k", "at", before, max_versions_to_probe=probe, max_group_rows=most)
            assert sorted((r.f, r.price) for r in got.collect()) == want, (before, probe, most)
