import os
from pathlib import Path

from pyspark.sql import functions as F, types as T

from tidegate.operators.changes import METADATA, as_change_feed
from tidegate.plans import gold
from tidegate.plans.bronze import CUSTOMER_RULES, ORDER_RULES, PRODUCT_RULES
from tidegate.plans.silver import clean_customers, clean_orders, clean_products
from tidegate.sources.csv_feed import SchemaStore, append_csv, csv_feed, infer_and_store_schema
from tidegate.streaming.runs import append_parquet, run_available
from tidegate.streaming.tables import MergeTarget, RawTable, enrich_commits, stream_commits


def write(folder: Path, name: str, text: str, second: int = 0) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    os.utime(folder / name, (1_700_000_000 + second, 1_700_000_000 + second))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# ---- event time

def test_late_rows_open_windows_and_null_times(spark, tmp_path):
    files = {"a": [(1, "10:01"), (2, "10:30")], "b": [(3, "10:02"), (4, "10:29"), (5, "10:26")],
             "c": [(6, "11:30"), (7, None), (8, "10:30"), (9, "10:03")]}
    for n, (name, lines) in enumerate(files.items()):
        text = "".join(f"{i},{'' if t is None else f'2026-01-01 {t}:00'}\n" for i, t in lines)
        write(tmp_path / "in", f"{name}.csv", "id,ts\n" + text, n)
    stream = csv_feed(spark, str(tmp_path / "in"), T.StructType.fromDDL("id int, ts timestamp"), max_files=1)
    windows = (stream.withWatermark("ts", "2 minutes").groupBy(F.window("ts", "5 minutes"))
               .agg(F.sort_array(F.collect_list("id")).alias("ids"))
               .select(F.date_format("window.start", "HH:mm").alias("start"), "ids"))
    query = run_available(append_parquet(windows, str(tmp_path / "out"), str(tmp_path / "checkpoint")))
    got = rows(spark.read.parquet(str(tmp_path / "out")), "start", "ids")
    assert got == [("10:00", [1, 3]), ("10:25", [4, 5]), ("10:30", [2, 8])]
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped == 1


# ---- CSV folders

def test_header_that_differs_stops_a_fixed_schema_stream(spark, tmp_path):
    write(tmp_path / "in", "a.csv", "v,id\nx,1\n")
    stream = csv_feed(spark, str(tmp_path / "in"), T.StructType.fromDDL("id int, v string"))
    try:
        run_available(append_parquet(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")))
    except Exception as error:
        assert "header" in str(error).lower()
    else:
        raise AssertionError("columns were bound by position")


def test_schema_is_inferred_once_and_kept(spark, tmp_path):
    write(tmp_path / "in", "a.csv", "id,price,day\n1,2.5,2026-01-01\n")
    store = SchemaStore(spark, str(tmp_path / "schema"))
    assert store.load() is None
    schema = infer_and_store_schema(spark, str(tmp_path / "in"), store)
    assert schema.simpleString() == "struct<id:int,price:double,day:string>"
    write(tmp_path / "in", "b.csv", "id,price,day\nx,y,z\n")
    assert infer_and_store_schema(spark, str(tmp_path / "in"), store) == schema


def test_new_columns_are_added_and_reordered_ones_found(spark, tmp_path):
    table, folder = RawTable("t", str(tmp_path / "table")), str(tmp_path / "in")
    write(tmp_path / "in", "a.csv", "id,ts,v\n1,d1,x\n")
    run_available(table.append_flow(spark, [folder]))
    assert table.schema_store(spark).load().names == ["id", "ts", "v"]
    write(tmp_path / "in", "b.csv", "ID,ts,v,extra\n2,d2,y,7\n")
    write(tmp_path / "in", "c.csv", "v,extra,id\nz,8,3\n")
    write(tmp_path / "in", "empty.csv", "")
    run_available(table.append_flow(spark, [folder]))
    assert rows(table.read(spark), "id", "ts", "v", "extra") == [
        (1, "d1", "x", None), (2, "d2", "y", 7), (3, None, "z", 8)]
    assert rows(table.changes(spark), "id", "_change_type", "_commit_version") == [
        (1, "insert", 0), (2, "insert", 1), (3, "insert", 1)]
    times = {r.v: r.t for r in table.changes(spark).groupBy(F.col("_commit_version").alias("v")).agg(
        F.max("_commit_timestamp").alias("t")).collect()}
    assert times[0] < times[1]


def test_two_feeds_into_one_table_with_rules_and_restart(spark, tmp_path):
    head = "order_id,quantity,amount,order_date\n"
    table = RawTable("orders", str(tmp_path / "table"), ORDER_RULES)
    write(tmp_path / "a", "1.csv", head + "1,1,5.0,d\n2,0,5.0,d\n")
    write(tmp_path / "b", "1.csv", head + "3,2,-5.0,d\n4,2,6.5,d\n5,2,6.5,\n")
    folders = [str(tmp_path / "a"), str(tmp_path / "b")]
    run_available(table.append_flow(spark, folders))
    assert rows(table.read(spark), "order_id") == [(1,), (4,)]
    run_available(table.append_flow(spark, folders))
    assert rows(table.read(spark), "order_id") == [(1,), (4,)]
    write(tmp_path / "b", "2.csv", head + "6,1,1.0,d\n7,-1,-1.0,\n")
    run_available(table.append_flow(spark, folders))
    assert rows(table.read(spark), "order_id") == [(1,), (4,), (6,)]
    assert rows(table.expectations(spark), "rule", "passed", "failed") == [
        ("amount", 5, 2), ("order_date", 5, 2), ("quantity", 5, 2)]


def test_files_beyond_the_pace_come_with_later_commits(spark, tmp_path):
    for n in range(5):
        write(tmp_path / "in", f"{n}.csv", f"id\n{n}\n", n)
    table = RawTable("t", str(tmp_path / "table"))
    run_available(table.append_flow(spark, [str(tmp_path / "in")], max_files=2))
    assert rows(table.changes(spark), "id", "_commit_version") == [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)]


# ---- merge targets

def commit(spark, data, version):
    df = spark.createDataFrame(data, "id string, v int, seq int")
    return as_change_feed(df, F.lit(version), F.timestamp_seconds(F.lit(version)))


def target(tmp_path, **options):
    options = {"keys": ("id",), "sequence_by": "seq", "except_columns": (*METADATA, "seq"), **options}
    return MergeTarget("t", str(tmp_path / "target"), **options)


COMMITS = [[("A", 1, 1), ("B", 1, 1), ("A", 0, 0)], [("C", 1, 2)], [("A", 3, 3), ("D", 1, 3)], [("B", 0, 0)],
           [("A", 2, 2), (None, 9, 9)], [("E", 1, 5), ("B", 2, 6)]]


def test_type_1_target_publishes_inserts_of_pure_commits(spark, tmp_path):
    t = target(tmp_path)
    for version, data in enumerate(COMMITS):
        t.merge(commit(spark, data, version), version)
    assert rows(t.read(spark), "*") == [("A", 3), ("B", 2), ("C", 1), ("D", 1), ("E", 1)]
    feed = rows(t.feed(spark), "_commit_version", "id", "v", "_change_type")
    assert feed == [(0, "A", 1, "insert"), (0, "B", 1, "insert"), (1, "C", 1, "insert"),
                    (2, "A", 3, "update_postimage"), (2, "D", 1, "insert"),
                    (5, "B", 2, "update_postimage"), (5, "E", 1, "insert")]
    out = str(tmp_path / "out")
    run_available(append_parquet(t.stream_appends(spark), out, str(tmp_path / "checkpoint")))
    assert rows(spark.read.parquet(out), "id") == [("A",), ("B",), ("C",)]


def test_row_granularity_keeps_inserts_of_rewriting_commits(spark, tmp_path):
    t = target(tmp_path, append_granularity="row")
    for version, data in enumerate(COMMITS):
        t.merge(commit(spark, data, version), version)
    out = str(tmp_path / "out")
    run_available(append_parquet(t.stream_appends(spark), out, str(tmp_path / "checkpoint")))
    assert rows(spark.read.parquet(out), "id") == [("A",), ("B",), ("C",), ("D",), ("E",)]


def test_repeated_commit_changes_nothing(spark, tmp_path):
    t, out = target(tmp_path), str(tmp_path / "out")
    for versions in ((0, 1, 2), (2, 1, 2)):
        for version in versions:
            t.merge(commit(spark, COMMITS[version], version), version)
        run_available(append_parquet(t.stream_appends(spark), out, str(tmp_path / "checkpoint")))
    assert rows(t.read(spark), "*") == [("A", 3), ("B", 1), ("C", 1), ("D", 1)]
    assert t.feed(spark).count() == 5
    assert rows(spark.read.parquet(out), "id") == [("A",), ("B",), ("C",)]


def test_compaction_keeps_late_changes_and_deletes_right(spark, tmp_path):
    deletes = F.col("v") == -1
    data = [[("A", 1, 1)], [("A", -1, 5)], [("A", 2, 3)], [("B", 7, 1)], [("A", 8, 4), ("B", 6, 0)]]
    kept, compacted = [target(tmp_path / str(every), compact_every=every, delete_when=deletes) for every in (99, 1)]
    for version, part in enumerate(data):
        for t in (kept, compacted):
            t.merge(commit(spark, part, version), version)
    assert rows(compacted.read(spark), "*") == rows(kept.read(spark), "*") == [("B", 7)]
    assert rows(compacted.feed(spark), "*") == rows(kept.feed(spark), "*")


def test_type_2_target_with_compaction(spark, tmp_path):
    """A change that arrives late splits a version that had looked unchanged."""
    want = [("A", 1, 1, 2), ("A", 2, 2, 3), ("A", 1, 3, None)]
    for every in (99, 1):
        t = target(tmp_path / str(every), scd_type=2, compact_every=every)
        for version, part in enumerate([[("A", 1, 1)], [("A", 1, 3)], [("A", 2, 2)]]):
            t.merge(commit(spark, part, version), version)
        assert rows(t.read(spark).orderBy("__START_AT"), "id", "v", "__START_AT", "__END_AT") == sorted(want, key=str)


# ---- enrichment and the whole way

def test_enrichment_sees_the_dimension_of_the_moment(spark, tmp_path):
    folder, places = str(tmp_path / "enriched"), str(tmp_path / "places")
    schema = T.StructType.fromDDL("customer_id string, city string")

    def save(city):
        spark.createDataFrame([("c", city)], schema).write.mode("overwrite").parquet(places)

    def run(n):
        write(tmp_path / "in", f"{n}.csv", f"order_id,customer_id\n{n},c\n{n + 10},unknown\n", n)
        stream = csv_feed(spark, str(tmp_path / "in"), T.StructType.fromDDL("order_id int, customer_id string"))
        run_available(enrich_commits(stream, lambda s: s.read.schema(schema).parquet(places), "customer_id", folder))

    save("old")
    run(1)
    save("new")
    run(2)
    joined = T.StructType.fromDDL("order_id int, customer_id string, city string")
    run_available(append_parquet(stream_commits(spark, folder, joined), str(tmp_path / "out"), str(tmp_path / "c")))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "order_id", "city") == [(1, "old"), (2, "new")]


ORDERS = "order_id,customer_id,product_id,quantity,payment_method,amount,order_date,sales_channel\n"
CUSTOMERS = "customer_id,customer_name,email,gender,date_of_birth,street_name,city,state\n"
PRODUCTS = "product_id,product_name,price,category,expiry_date\n"


def test_from_files_to_results(spark, tmp_path):
    raw = {"orders": RawTable("orders", str(tmp_path / "raw_orders"), ORDER_RULES),
           "customers": RawTable("customers", str(tmp_path / "raw_customers"), CUSTOMER_RULES),
           "products": RawTable("products", str(tmp_path / "raw_products"), PRODUCT_RULES)}
    clean = {"orders": clean_orders, "customers": clean_customers, "products": clean_products}
    merged = {"orders": MergeTarget("orders", str(tmp_path / "orders"), ("order_id",)),
              "customers": MergeTarget("customers", str(tmp_path / "customers"), ("customer_id",)),
              "products": MergeTarget("products", str(tmp_path / "products"), ("product_id",), scd_type=2)}

    def deliver(n, **texts):
        for name, text in texts.items():
            write(tmp_path / "in" / name, f"{n}.csv", text, n)
            run_available(raw[name].append_flow(spark, [str(tmp_path / "in" / name)]))
            run_available(merged[name].apply_changes(raw[name].stream_changes(spark), clean[name]))

    deliver(1, customers=CUSTOMERS + "c1, ann  lee ,a@x,F,31/08/1990,Road 1,Town,State\nc2,bo,,M,1990-01-01,Road 2,Town,State\n",
            products=PRODUCTS + "p1,home APPLIANCES,10.0,Iron,2027/01/01\np2,toys,-1.0,Car,2027-01-01\n",
            orders=ORDERS + "1,c1,p1,2,Cash,10.0,2026-01-01 10:01:00,Online\n1,c1,p1,2,Cash,10.0,2026-01-01 10:01:00,Online\n"
                            "2,c1,p1,1,UPI,10.0,01/01/2026 10:02:30,Store\n3,c2,p1,1,UPI,10.0,2026/01/01 10:02:30,Store\n")
    deliver(2, products=PRODUCTS + "p1,home APPLIANCES,12.0,Iron,2027/01/01\n",
            orders=ORDERS + "4,c1,p1,1,UPI,12.0,2026-01-01 10:30:00,Store\n5,,p1,1,UPI,1.0,2026-01-01 10:30:00,Store\n")
    # An update of order 1 in the same commit as a new order: the commit is not append-only.
    deliver(3, orders=ORDERS + "1,c1,p1,9,Card,10.0,2026-01-01 10:01:00,Online\n6,c1,p1,1,UPI,12.0,2026-01-01 11:30:00,Store\n")

    assert rows(merged["customers"].read(spark), "customer_id", "customer_name") == [("c1", "ANN  LEE")]
    assert rows(merged["products"].read(spark), "product_name", "price", F.col("__END_AT").isNull()) == [
        ("Home Appliances", 10.0, False), ("Home Appliances", 12.0, True)]
    orders = merged["orders"].read(spark)
    assert rows(orders, "order_id", "quantity", "payment_method", "total_amount") == [
        (1, 9, "Card", 90.0), (2, 1, "UPI", 10.0), (3, 1, "UPI", 10.0), (4, 1, "UPI", 12.0), (6, 1, "UPI", 12.0)]
    assert rows(gold.payment_analysis(orders), "*") == [
        ("Card", 10.0, 1, 10.0, 10.0, 10.0), ("UPI", 44.0, 4, 11.0, 12.0, 10.0)]

    def streamed(result, name):
        run_available(append_parquet(result, str(tmp_path / name), str(tmp_path / f"{name}_checkpoint")))
        return spark.read.schema(result.schema).parquet(str(tmp_path / name))

    behavior = streamed(gold.customer_behavior(merged["orders"].stream_appends(spark),
                                               merged["customers"].read(spark)), "behavior")
    assert rows(behavior, F.date_format("window_start", "HH:mm"), "customer_id", "total_spent", "purchase_count",
                "avg_purchase_value", "customer_segment") == [("10:00", "c1", 20.0, 2, 10.0, "Bronze")]
    performance = streamed(gold.product_performance(merged["orders"].stream_appends(spark),
                                                    merged["products"].read(spark)), "performance")
    assert rows(performance, "product_id", "price", "units_sold", "order_frequency") == [("p1", 12.0, 4, 3)]
    demand = gold.price_demand_analysis(orders, merged["products"].read(spark))
    assert rows(demand, "category", "current_price", "current_demand") == [("Iron", 10.0, 13)]


# ---- lossless ingest

def _ingest(spark, tmp_path, table, deliveries):
    for n, files in enumerate(deliveries):
        for name, text in files.items():
            write(tmp_path / "in", name, text, n)
        run_available(table.append_flow(spark, [str(tmp_path / "in")]))


def test_types_widen_and_misfits_are_rescued(spark, tmp_path):
    table = RawTable("t", str(tmp_path / "t"))
    _ingest(spark, tmp_path, table, [
        {"a.csv": "id,amount\n1,5\n2,6\n", "b.csv": "amount,id\n5.75,3\n"}, {"c.csv": "id,amount\nA4,7e3\n12345678901,\n"}])
    got = rows(table.read(spark, rescued="kept").withColumn("kept", F.col("kept.id")), "id", "amount", "kept")
    assert got == sorted([(1, 5.0, None), (2, 6.0, None), (3, 5.75, None), (None, 7000.0, "A4"), (12345678901, None, None)], key=str)
    assert rows(table.rescued_values(spark), "column_name", "rescued") == [("amount", 0), ("id", 1)]


def test_a_text_in_a_number_column_breaks_its_rule_and_not_the_feed(spark, tmp_path):
    table = RawTable("t", str(tmp_path / "t"), {"quantity": "quantity > 0"}, "orders", {"quantity": "int", "phone": "string"})
    _ingest(spark, tmp_path, table, [{"a.csv": "id,quantity,phone\n1,n/a,+4401\n2,3,007\n"}, {"b.csv": "id,quantity,phone\n3,4,1\n"}])
    assert rows(table.read(spark), "id", "quantity", "phone") == [(2, 3, "007"), (3, 4, "1")]
    assert rows(table.expectations(spark), "rule", "passed", "failed") == [("quantity", 2, 1)]
    assert rows(table.rescued_values(spark).filter("rescued > 0"), "column_name", "rescued") == [("quantity", 1)]
    assert {r.table_comment for r in table.describe(spark).collect()} == {"orders"}


def test_old_files_and_odd_names_are_read_once(spark, tmp_path):
    table = RawTable("t", str(tmp_path / "t"))
    write(tmp_path / "in", "sales1.csv", "id\n2\n", 0)
    write(tmp_path / "in", "sales[1].csv", "id\n1\n", 0)
    write(tmp_path / "in", "a b%20{x}.csv", "id\n5\n", 0)
    run_available(table.append_flow(spark, [str(tmp_path / "in")]))
    write(tmp_path / "in", "late.csv", "id\n3\n", -30 * 86400)
    write(tmp_path / "in", "new.csv", "id\n4\n", 86400)
    run_available(table.append_flow(spark, [str(tmp_path / "in")]))
    assert rows(table.read(spark), "id") == [(1,), (2,), (3,), (4,), (5,)]


def test_jobs_for_headers_do_not_grow_with_files(spark, tmp_path):
    from tidegate.sources.csv_feed import group_by_header

    tracker, jobs = spark.sparkContext.statusTracker(), []
    for count in (40, 120):
        for n in range(count):
            write(tmp_path / str(count), f"{n}.csv", f"id,{'v' if n % 2 else 'w'}\n{n},1\n")
        group = f"headers-{count}"
        spark.sparkContext.setJobGroup(group, group)
        found = group_by_header(spark, [str(p) for p in (tmp_path / str(count)).iterdir()])
        jobs.append(len(tracker.getJobIdsForGroup(group)))
        assert sorted(found) == [("id", "v"), ("id", "w")]
    spark.sparkContext.setJobGroup("", "")
    assert jobs[0] == jobs[1]


def test_csv_keeps_blanks(spark, tmp_path):
    df = spark.createDataFrame([("  x ", 1)], "s string, i int")
    append_csv(df, str(tmp_path / "out"))
    assert rows(spark.read.schema(df.schema).option("header", "true").csv(str(tmp_path / "out")), "s", "i") == [("  x ", 1)]


def test_change_kinds_around_deletes(spark, tmp_path):
    target = MergeTarget("t", str(tmp_path / "t"), ("id",), sequence_by="seq", delete_when=F.col("gone"))
    for version, (i, seq, gone) in enumerate([(1, 1, False), (1, 2, True), (1, 3, False), (9, 4, True), (1, 5, False)]):
        target.merge(spark.createDataFrame([(i, seq, gone)], "id int, seq int, gone boolean"), version)
    assert rows(target.feed(spark), "seq", "_change_type") == [
        (1, "insert"), (2, "delete"), (3, "insert"), (5, "update_postimage")]
