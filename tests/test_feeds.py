"""The change feed of a type 2 target, and copies that come in later micro-batches."""

from pyspark.sql import functions as F

from tidegate.operators.changes import METADATA, as_change_feed, dedup_stream
from tidegate.streaming.runs import append_parquet, run_available
from tidegate.streaming.tables import MergeTarget

COMMITS = [[("A", 1, 1), ("B", 5, 1)], [("A", 2, 9)], [("A", 2, 4)], [("B", 0, 7), ("A", 1, 2)], [("A", 3, 6), ("C", 1, 1)], [("B", 5, 9)]]


def sort(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_changes_of_versions_rebuild_the_table(spark, tmp_path):
    """Late changes cut versions anew; the value 0 deletes. Every commit, also a repeated one, leaves the feed right."""
    for every in (99, 2):
        t = MergeTarget("t", str(tmp_path / str(every)), ("id",), scd_type=2, sequence_by="seq", compact_every=every,
                        except_columns=(*METADATA, "seq"), delete_when=F.col("v") == 0)
        for version, data in enumerate(COMMITS):
            rows = as_change_feed(spark.createDataFrame(data, "id string, v int, seq int"), F.lit(version), F.timestamp_seconds(F.lit(version)))
            for _ in range(2 if version == 3 else 1):
                t.merge(rows, version)
        assert sort(t.rebuild(t.feed(spark)), "*") == sort(t.read(spark), "*")
        feed = sort(t.feed(spark), "_commit_version", "id", "v", "__START_AT", "__END_AT", "_change_type")
        assert [r for r in feed if r[0] == 2] == [
            (2, "A", 1, 1, 4, "update_postimage"), (2, "A", 2, 4, None, "insert"), (2, "A", 2, 9, None, "delete")]
        assert [r for r in feed if r[0] == 3] == [(3, "B", 5, 1, 7, "update_postimage")]
    out = str(tmp_path / "out")
    run_available(append_parquet(t.stream_versions(spark), out, str(tmp_path / "c")))
    assert spark.read.parquet(out).count() == t.feed(spark).count()


def test_copies_in_later_micro_batches_and_their_state(spark, tmp_path):
    folder, schema = str(tmp_path / "in"), "id int, at timestamp, v string"

    def deliver(*rows):
        data = [(i, None if t is None else f"2026-01-01 10:{t:02}:00", v) for i, t, v in rows]
        spark.createDataFrame(data, "id int, t string, v string").select(
            "id", F.col("t").cast("timestamp").alias("at"), "v").coalesce(1).write.mode("append").parquet(folder)
        stream = dedup_stream(spark.readStream.schema(schema).parquet(folder), "at", "10 minutes")
        query = run_available(append_parquet(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")))
        return query.recentProgress[-1].stateOperators[0].numRowsTotal

    held = [deliver((1, 0, "a"), (1, 0, "a"), (1, 0, None), (2, None, "b")), deliver((1, 0, "a"), (3, 5, "c"), (1, 0, "null")),
            deliver((4, 50, "d")), deliver((4, 50, "d"), (5, 55, "e"))]
    assert sort(spark.read.schema(schema).parquet(str(tmp_path / "out")), "id", "v") == [
        (1, "a"), (1, "null"), (1, None), (2, "b"), (3, "c"), (4, "d"), (5, "e")]
    assert max(held) <= 4 and held[-1] == 2
