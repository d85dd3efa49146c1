"""Types, commits and streams of raw tables, whatever the order of the files."""

import itertools

import pytest
from pyspark.sql import functions as F, types as T

from tidegate.session import remove_path
from tidegate.sources.csv_feed import KINDS, add_counts, first_record, kind_counts, type_of
from tidegate.streaming.runs import append_parquet, run_available, run_live
from tidegate.streaming.tables import MergeTarget, RawTable

FILES = [["5", "6"], ["5.75"], ["abc", None], ["12345678901", "7"], ["8", "9", "-1"]]


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode())


def flow(spark, table, folder):
    run_available(table.append_flow(spark, [str(folder)]))


def sort(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def counted(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return df.agg(*kind_counts({"v": "v"})).first().asDict()


def test_types_depend_on_no_order_and_no_cut(spark):
    """All orders of five files, each file a commit or all in one."""
    counts = [counted(spark, values) for values in FILES]

    def after(commits):
        schema = T.StructType([])
        for found in commits:
            totals = add_counts(schema, ["v"], found)
            schema = T.StructType([T.StructField("v", T.StringType(), True, {"counts": totals["v"]})])
        return totals["v"]

    whole = after([{f"{k}_0": sum(c[f"{k}_0"] for c in counts) for k in KINDS}])
    assert type_of(whole) == "double"
    assert all(after(order) == whole for order in itertools.permutations(counts))


@pytest.mark.parametrize("values, kind", [
    (["5", "abc"], "string"), (["abc", "5"], "string"), ([None, None], "string"), ([None, "5"], "int"), (["", "5"], "string"),
    (["5", "6", "n/a"], "int"), (["5", "3000000000"], "bigint"), (["1", "2.5"], "double"), (["007", "8", "9"], "string"),
    (["+44123", "5", "6"], "string"), (["true", "false"], "boolean"), (["true", "no"], "string"), (["true", "1"], "string"),
    (["2024-01-05", "2024-01-06"], "string"), (["1e3", "5"], "double")])
def test_kinds_of_values(spark, values, kind):
    counts = counted(spark, values)
    assert type_of({k: counts[f"{k}_0"] for k in KINDS}) == kind


def test_a_repeated_commit_reports_the_same(spark, tmp_path):
    """The rows stand, but the driver was lost before the commit was noted down."""
    for rules, declared in (({"v": "v > 2"}, {"v": "int"}), ({"v": "v > 2"}, {}), ({}, {})):
        folder = tmp_path / f"{len(rules)}{len(declared)}"
        table = RawTable("t", str(folder / "t"), rules, types=declared)
        write(folder / "in", "a.csv", "id,v\n1,1\n2,2\n3,x\n4,4\n5,5\n")
        flow(spark, table, folder / "in")
        reports = [sort(table.rescued_values(spark), "*"), sort(table.expectations(spark), "*") if rules else [], sort(table.read(spark), "*")]
        files = sorted(p.name for p in (folder / "t/data/_commit_version=0").glob("part-*"))
        for lost in ("log", "rescued", "expectations", "schema", "checkpoint/commits/0", "checkpoint/commits/.0.crc"):
            remove_path(spark, str(folder / "t" / lost))
        flow(spark, table, folder / "in")
        assert files == sorted(p.name for p in (folder / "t/data/_commit_version=0").glob("part-*"))
        assert reports == [sort(table.rescued_values(spark), "*"), sort(table.expectations(spark), "*") if rules else [], sort(table.read(spark), "*")]
        assert ("v", 5, 1) in reports[0] and not (folder / "t/between/_commit_version=0").exists()


def test_rules_and_counts_take_one_pass(spark, tmp_path, monkeypatch):
    """The files are read by one job, and only their first bytes before it."""
    import tidegate.streaming.tables as tables

    reads, text = [], tables.read_as_text
    monkeypatch.setattr(tables, "read_as_text", lambda *a: reads.append(spark.sparkContext.accumulator(0)) or _counting(text(*a), reads[-1]))

    def _counting(df, seen):
        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return df.mapInArrow(count, df.schema)

    for k, declared in enumerate(({"v": "int"}, {})):
        write(tmp_path / str(k), "a.csv", "id,v\n" + "".join(f"{n},{n}\n" for n in range(500)))
        flow(spark, RawTable("t", str(tmp_path / f"t{k}"), {"v": "v > 2"}, types=declared), tmp_path / str(k))
    assert [r.value for r in reads] == [500, 500]


def test_a_running_stream_follows_wider_types_and_new_columns(spark, tmp_path):
    table = RawTable("t", str(tmp_path / "t"))
    write(tmp_path / "in", "a.csv", "id,v\n1,5\n")
    flow(spark, table, tmp_path / "in")
    target = MergeTarget("m", str(tmp_path / "m"), ("id",))
    running = run_live(target.apply_changes(table, lambda rows: rows, spark), "0 seconds")
    try:
        running.processAllAvailable()
        write(tmp_path / "in", "b.csv", "id,v,w\n2,5.75,x\n1,6,y\n")
        flow(spark, table, tmp_path / "in")
        running.processAllAvailable()
    finally:
        running.stop()
    assert sort(target.read(spark), "id", "v", "w") == [(1, 6.0, "y"), (2, 5.75, "x")]
    assert sort(target.read(spark, as_of=0), "id", "v") == [(1, 5)]
    assert sort(target.feed(spark), "id", "v", "_change_type") == [(1, 5.0, "insert"), (1, 6.0, "update_postimage"), (2, 5.75, "insert")]


def test_a_stream_with_fixed_types_stops_rather_than_lose_a_number(spark, tmp_path):
    table = RawTable("t", str(tmp_path / "t"))
    write(tmp_path / "in", "a.csv", "id,v\n1,5\n2,6\n")
    flow(spark, table, tmp_path / "in")
    stream = table.stream_changes(spark)
    write(tmp_path / "in", "b.csv", "id,v\n3,5.75\n")
    flow(spark, table, tmp_path / "in")
    with pytest.raises(Exception, match="widened"):
        run_available(append_parquet(stream, str(tmp_path / "out"), str(tmp_path / "c")))
    run_available(append_parquet(table.stream_changes(spark), str(tmp_path / "out2"), str(tmp_path / "c2")))
    assert sort(spark.read.parquet(str(tmp_path / "out2")), "v") == [(5.0,), (5.75,), (6.0,)]


def test_a_line_break_in_a_header(spark, tmp_path):
    write(tmp_path / "in", "a.csv", '\n"a\nb",c\n1,"x\ny"\n2,z\n')
    write(tmp_path / "in", "b.csv", "")
    table = RawTable("t", str(tmp_path / "t"))
    flow(spark, table, tmp_path / "in")
    assert sort(table.read(spark), F.col("`a\nb`"), "c") == [(1, "x\ny"), (2, "z")]
    assert first_record(spark, str(tmp_path / "in" / "a.csv"), size=3) == ["a\nb", "c"]
    assert first_record(spark, str(tmp_path / "in" / "b.csv")) == []
