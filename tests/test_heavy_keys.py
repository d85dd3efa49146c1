"""Keys that hold most rows: ranges by count, carried sums, and joins dealt out by counted parts."""

import datetime as dt
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from tidegate.operators import ordered
from tidegate.operators.changes import as_change_feed
from tidegate.operators.ordered import CHUNK, SPLITS, running_total_before, split_points, with_chunks, with_next, with_previous, written, written_alone
from tidegate.operators.scd import scd2
from tidegate.operators.skew import heavy_hitters, salted_join
from tidegate.session import remove_path
from tidegate.streaming.runs import run_available
from tidegate.streaming.tables import MergeTarget, enrich_commits

DAY = dt.datetime(2026, 1, 1)


def sort(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def one_day(spark, n=400):
    """One key with n distinct times of one day, crowded in its first minute, and a few other keys."""
    hot = [("hot", DAY + dt.timedelta(milliseconds=i if i < n - 20 else 1000 * i), i) for i in range(n)]
    return spark.createDataFrame(hot + [("a", DAY, 1), ("b", DAY, 2), ("b", None, 3)], "k string, t timestamp, v int")


def test_no_range_holds_more_rows_than_a_task_may(spark):
    df = one_day(spark)
    heavy = spark.createDataFrame([("hot",)], "k string")
    chunked = with_chunks(df, heavy, ["k"], "t", 30)
    sizes = {r["k"]: [] for r in df.collect()}
    for r in chunked.groupBy("k", CHUNK).count().collect():
        sizes[r["k"]].append(r["count"])
    assert max(sizes["hot"]) <= 30 and len(sizes["hot"]) <= 2 * 400 / 30 + 1 and sizes["a"] == [1]
    splits = split_points(df.filter("k = 'hot'"), ["k"], "t", 30).first()[SPLITS]
    assert splits == sorted(set(splits))
    for step in (with_previous, with_next):
        plain, cut = (sort(step(df.filter("t IS NOT NULL"), ["k"], "t", F.col("v"), "x", h, 30), "k", "v", "x") for h in (None, heavy))
        assert plain == cut


@pytest.mark.parametrize("fits", [10, 1000])
def test_ranges_are_counted_off_where_a_key_fits_a_task(spark, fits, monkeypatch):
    """Counted or sketched, ranges keep their bound, and no key that fits a task is sketched."""
    sketched = []
    monkeypatch.setattr(ordered, "split_points", lambda df, *a: sketched.append(df.select("k").distinct().count()) or split_points(df, *a))
    df = one_day(spark).unionByName(spark.createDataFrame([("c", DAY, i) for i in range(8)] + [(None, DAY, 9)], "k string, t timestamp, v int"))
    heavy = spark.createDataFrame([("hot",), ("b",), ("c",)], "k string")
    rows = with_chunks(df, heavy, ["k"], "t", 6, fits).collect()
    assert len(rows) == df.count() and sketched == ([1] if fits < 400 else [])
    assert all(r[CHUNK] is None for r in rows if r["k"] in ("a", None)) and len({r[CHUNK] for r in rows if r["k"] == "c"}) == 1
    hot = sorted((r["t"], r[CHUNK]) for r in rows if r["k"] == "hot")
    assert [c for _, c in hot] == sorted(c for _, c in hot)
    assert max(sum(c == k for _, c in hot) for k in {c for _, c in hot}) <= 6
    assert {r[CHUNK] for r in rows if r["k"] == "b" and r["t"] is None} == {-1}


@pytest.mark.parametrize("limit", [1, 7, 1000])
def test_history_and_running_total_of_one_day(spark, limit):
    df = one_day(spark, 120).filter("t IS NOT NULL")
    feed = as_change_feed(df.withColumnRenamed("t", "seq"), F.lit(0), F.lit(DAY))
    plain, cut = (sort(scd2(feed, ["k"], "seq", max_group_rows=m), "k", "v", "__START_AT", "__END_AT") for m in (10_000, limit))
    assert plain == cut
    totals = [sort(running_total_before(df, df.select("t"), "t", "v", m), "*") for m in (10_000, limit)]
    assert totals[0] == totals[1] and len(totals[0]) == 120


def test_written_steps_leave_neither_shuffle_files_nor_tables_behind(spark):
    root = f"{spark.conf.get('spark.checkpoint.dir')}/tidegate"
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+\.(?:data|index)", files.getAllFiles().mkString(" ")))
    tables = lambda: {f.split("-")[0] for f in os.listdir(root)} - old
    written(one_day(spark), "first")
    before, old = shuffled(), {f.split("-")[0] for f in os.listdir(root)}
    kept = []

    def build():
        counts = written(one_day(spark).groupBy("k").count(), "step_inside")
        kept.append(written_alone(spark, lambda: written(counts, "step_within").filter("count > 0"), "step_nested"))
        assert tables() == {"step_inside", "step_nested"}
        return kept[0].join(counts, ["k", "count"])

    result = written_alone(spark, build, "step_result")
    assert tables() == {"step_result"} and sort(result, "*") == [("a", 1), ("b", 2), ("hot", 400)]
    assert sort(written_alone(spark, lambda: written(result, "step_twice"), "step_other"), "*") == sort(result, "*")
    for _ in range(50):
        if not (left := shuffled() - before):
            break
        time.sleep(0.2)
    assert not left and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) != "true"


@pytest.mark.parametrize("fits", [10, 1000])
def test_ranges_are_cut_once_and_their_sources_removed(spark, fits):
    root = f"{spark.conf.get('spark.checkpoint.dir')}/tidegate"
    heavy, old = spark.createDataFrame([("hot",)], "k string"), set(os.listdir(root))
    rows = with_chunks(one_day(spark), heavy, ["k"], "t", 30, fits)
    assert {f.split("-")[0] for f in set(os.listdir(root)) - old} == {"ranges"}
    assert rows.count() == 403 and "Window" not in rows._jdf.queryExecution().toString()


def test_salted_join(spark):
    facts = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 7 == 0, None)
                                              .otherwise(F.concat(F.lit("k"), F.col("id") % 10)).alias("k"), "id", F.lit("clash").alias("n"))
    places = spark.createDataFrame([("hot", "x"), ("hot", "second"), ("k1", "y"), ("k5", None), ("other", "z")], "k string, place string")
    assert {r["k"]: r["__salts"] for r in heavy_hitters(facts, "k", 100).collect()}["hot"] == 20
    want = sort(facts.join(places, "k"), "k", "id", "n", "place")
    for limit in (1, 100, 10_000):
        assert sort(salted_join(facts, places, "k", limit), "k", "id", "n", "place") == want
    assert salted_join(facts.limit(0), places, "k", 1).count() == 0


def test_a_repeated_micro_batch_meets_the_same_dimension(spark, tmp_path):
    target = MergeTarget("t", str(tmp_path / "t"), ("k",), publish=False, compact_every=1)

    def report(version, place):
        target.merge(as_change_feed(spark.createDataFrame([("a", place)], "k string, place string"), F.lit(version),
                                    F.timestamp_seconds(F.lit(version))), version)

    def run():
        stream = spark.readStream.schema("k string, id int").parquet(str(tmp_path / "in"))
        run_available(enrich_commits(stream, target, "k", str(tmp_path / "out")))

    report(0, "old")
    spark.createDataFrame([("a", 1)], "k string, id int").write.parquet(str(tmp_path / "in"))
    run()
    for version in (1, 2, 3):
        report(version, f"new {version}")
    for lost in ("checkpoint/commits/0", "checkpoint/commits/.0.crc", "enriched/_commit_version=0"):
        remove_path(spark, str(tmp_path / "out" / lost))
    run()
    spark.createDataFrame([("a", 2)], "k string, id int").write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert sort(spark.read.parquet(str(tmp_path / "out/enriched")), "id", "place") == [(1, "old"), (2, "new 3")]
    assert [target.read(spark, v).first()["place"] for v in (0, 1, 2, 3)] == ["old", "new 1", "new 2", "new 3"]
    assert target.last_version(spark) == 3
