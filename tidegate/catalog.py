"""Every operator and business result as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import adapters as feeds
from .functions import as_amount, customer_segment, direction, exact, parse_date, parse_timestamp
from .operators import changes as ch, scd
from .operators.ordered import shuffles_released, with_previous
from .operators.quality import expect_all_or_drop, expectation_report
from .operators.temporal import as_of_version_join
from .plans import gold
from .plans.bronze import (CUSTOMER_RULES, CUSTOMER_TYPES, ORDER_RULES, ORDER_TYPES, PRODUCT_RULES, PRODUCT_TYPES)
from .plans.silver import clean_customers, clean_orders, clean_products, tidy_customers, tidy_orders, tidy_products
from .session import remove_path, work_dir
from .sources.csv_feed import (ANY_AGE, SchemaStore, append_csv, csv_feed, infer_and_store_schema, schema_as_rows)
from .streaming.runs import append_parquet, materialize, run_available, run_live
from .streaming.tables import MergeTarget, RawTable, enrich_commits, stream_commits

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Event times and parsed texts mean UTC.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf_dir.rstrip("/"))

        QUERIES[name] = run
        return run

    return register


def _t(spark, sf_dir, *names) -> list[DataFrame]:
    return [feeds.table(spark, sf_dir, name) for name in names]


def _orders_feed(spark, sf_dir):
    return feeds.orders_feed(*_t(spark, sf_dir, "events"))


def _customers_feed(spark, sf_dir):
    return feeds.customers_feed(*_t(spark, sf_dir, "customer", "nation", "region"))


def _products_feed(spark, sf_dir):
    return feeds.products_feed(*_t(spark, sf_dir, "lineitem", "part"))


def _sales(spark, sf_dir):
    return feeds.sales_feed(*_t(spark, sf_dir, "orders", "lineitem"))


def _orders(spark, sf_dir):
    rows = tidy_orders(expect_all_or_drop(_orders_feed(spark, sf_dir), ORDER_RULES))
    return scd.scd1(rows, ["order_id"], "order_id", [])


def _customers(spark, sf_dir):
    rows = tidy_customers(expect_all_or_drop(_customers_feed(spark, sf_dir), CUSTOMER_RULES))
    return scd.scd1(rows, ["customer_id"], "customer_id", [])


def _history(spark, sf_dir):
    lineitem, part = _t(spark, sf_dir, "lineitem", "part")
    updates = feeds.product_updates(lineitem, part)
    return scd.scd2(tidy_products(expect_all_or_drop(updates, PRODUCT_RULES)), ["product_id"],
                    sized_by=_product_keys(lineitem))


def _product_keys(lineitem):
    """One row per sale and per raw price: cheap to count, and no product has more sales or versions."""
    return lineitem.select(feeds.key_of("PROD", F.col("l_partkey")).alias("product_id"))


def _current_table(spark, sf_dir):
    return _stored(spark, scd.current(_history(spark, sf_dir)), "current_products")


def _history_table(spark, sf_dir):
    return _stored(spark, _history(spark, sf_dir), "products")


def _order_stream(spark, sf_dir):
    """Cleaned orders as a stream. Order ids are unique, so no commit rewrites a row."""
    raw = feeds.orders_feed(feeds.stream_table(spark, sf_dir, "events"))
    return tidy_orders(expect_all_or_drop(raw, ORDER_RULES))


def _streamed(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    folder = work_dir(spark, label)
    run_available(append_parquet(df, f"{folder}/out", f"{folder}/checkpoint"))
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


def _stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """A dimension as a table, which micro-batches read and whose size the planner knows."""
    folder = work_dir(spark, label)
    with shuffles_released(spark):
        materialize(df, folder)
    return spark.read.schema(df.schema).parquet(folder)


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# ---- sources and sinks

@query("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    feed, folder = _orders_feed(spark, sf_dir), work_dir(spark, "csv")
    append_csv(feed, folder)
    return spark.read.schema(feed.schema).option("header", "true").csv(folder)


@query("csv_feed_ingest")
def csv_feed_ingest(spark, sf_dir):
    feed, folder = _orders_feed(spark, sf_dir), work_dir(spark, "csv")
    append_csv(feed, folder)
    return _streamed(spark, csv_feed(spark, folder, feed.schema), "ingest")


@query("schema_infer")
def schema_infer(spark, sf_dir):
    folder = work_dir(spark, "infer")
    append_csv(_customers_feed(spark, sf_dir), f"{folder}/in")
    store = SchemaStore(spark, f"{folder}/schema")
    infer_and_store_schema(spark, f"{folder}/in", store)
    return schema_as_rows(spark, store.load())


@query("schema_evolution_add_columns")
def schema_evolution_add_columns(spark, sf_dir):
    """The first commit has files without the sales channel; the second has it, in another column order."""
    even, odd = feeds.orders_feed_halves(*_t(spark, sf_dir, "events"))
    folder = work_dir(spark, "evolve")
    table = RawTable("orders", f"{folder}/table")
    append_csv(even.drop("sales_channel"), f"{folder}/in")
    run_available(table.append_flow(spark, [f"{folder}/in"]))
    append_csv(odd.select("sales_channel", *reversed(odd.columns[:-1])), f"{folder}/in")
    run_available(table.append_flow(spark, [f"{folder}/in"]))
    return table.read(spark).select(*_typed(odd.schema))


@query("append_flow_fan_in")
def append_flow_fan_in(spark, sf_dir):
    return _raw_orders(spark, sf_dir, {}).select(*_typed(_orders_feed(spark, sf_dir).schema))


@query("bronze_orders")
def bronze_orders(spark, sf_dir):
    return _raw_orders(spark, sf_dir, ORDER_RULES).select(*_typed(_orders_feed(spark, sf_dir).schema))


@query("bronze_customers")
def bronze_customers(spark, sf_dir):
    feed, folder = _customers_feed(spark, sf_dir), work_dir(spark, "customers")
    table = RawTable("customers", f"{folder}/table", CUSTOMER_RULES, "raw customers", CUSTOMER_TYPES)
    append_csv(feed, f"{folder}/in")
    run_available(table.append_flow(spark, [f"{folder}/in"]))
    return table.read(spark)


@query("bronze_products")
def bronze_products(spark, sf_dir):
    feed, folder = _products_feed(spark, sf_dir).drop("l_shipdate"), work_dir(spark, "products")
    table = RawTable("products", f"{folder}/table", PRODUCT_RULES, "raw products", PRODUCT_TYPES)
    append_csv(feed, f"{folder}/in")
    run_available(table.append_flow(spark, [f"{folder}/in"]))
    return table.read(spark)


def _typed(schema):
    """Inference picks the narrowest type; the result is compared in the type of the feed."""
    return [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]


def _order_table(spark, sf_dir, rules) -> RawTable:
    folder = work_dir(spark, "orders")
    table = RawTable("orders", f"{folder}/table", rules, "raw orders of two regions", ORDER_TYPES)
    halves = dict(zip(("a", "b"), feeds.orders_feed_halves(*_t(spark, sf_dir, "events"))))
    for name, half in halves.items():
        append_csv(half, f"{folder}/{name}")
    run_available(table.append_flow(spark, [f"{folder}/{name}" for name in halves]))
    return table


def _raw_orders(spark, sf_dir, rules):
    return _order_table(spark, sf_dir, rules).read(spark)


def _drifting_orders(spark, sf_dir) -> RawTable:
    """Amounts come in whole units first and with cents later, in another column order; no type is declared. Some
    quantities of the second delivery are no numbers."""
    even, odd = feeds.orders_feed_halves(*_t(spark, sf_dir, "events"))
    folder = work_dir(spark, "drift")
    table = RawTable("orders", f"{folder}/table")
    append_csv(even.withColumn("amount", F.floor(F.abs("amount"))), f"{folder}/in")
    run_available(table.append_flow(spark, [f"{folder}/in"]))
    unreadable = F.when(F.col("order_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("quantity").cast("string"))
    append_csv(odd.withColumn("quantity", unreadable).select(*reversed(odd.columns)), f"{folder}/in")
    run_available(table.append_flow(spark, [f"{folder}/in"]))
    return table


@query("schema_drift_widening")
def schema_drift_widening(spark, sf_dir):
    return _drifting_orders(spark, sf_dir).read(spark).select("order_id", "quantity", "amount")


@query("rescued_values")
def rescued_values(spark, sf_dir):
    rows = _drifting_orders(spark, sf_dir).read(spark, rescued="kept")
    return rows.select("order_id", F.try_element_at("kept", F.lit("quantity")).alias("rescued_quantity"))


@query("schema_order_free")
def schema_order_free(spark, sf_dir):
    """The same three deliveries in three orders and cuts: whole amounts, amounts with cents, unreadable quantities. All
    tables come to the same types and rows."""
    feed = _orders_feed(spark, sf_dir).select("order_id", "quantity", "amount", "payment_method")
    part, folder = F.col("order_id") % 3, work_dir(spark, "orders_of_files")
    deliveries = [feed.filter(part == 0).withColumn("amount", F.floor(F.abs("amount"))),
                  feed.filter(part == 1).select("payment_method", "amount", "quantity", "order_id"),
                  feed.filter(part == 2).withColumn("quantity", F.when(F.col("order_id") % 7 == 0, F.lit("n/a"))
                                                    .otherwise(F.col("quantity").cast("string")))]
    tables = []
    for run, commits in enumerate([[[0], [1], [2]], [[2], [1], [0]], [[1, 2, 0]]]):
        table = RawTable("orders", f"{folder}/table_{run}")
        for parts in commits:
            for k in parts:
                append_csv(deliveries[k], f"{folder}/in_{run}")
            run_available(table.append_flow(spark, [f"{folder}/in_{run}"]))
        tables.append(table.read(spark).select(F.lit(run).alias("run"), "order_id", "quantity", "amount", "payment_method"))
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


@query("stream_type_widening")
def stream_type_widening(spark, sf_dir):
    """Amounts turn from whole units to cents, and a column is added, while the stream that reads them runs."""
    even, odd = feeds.orders_feed_halves(*_t(spark, sf_dir, "events"))
    folder = work_dir(spark, "widening")
    table, target = RawTable("orders", f"{folder}/table"), MergeTarget("orders", f"{folder}/orders", ("order_id",), publish=False)
    append_csv(even.select("order_id", F.floor(F.abs("amount")).alias("amount")), f"{folder}/in")
    run_available(table.append_flow(spark, [f"{folder}/in"]))
    running = run_live(target.apply_changes(table, lambda rows: rows, spark), "0 seconds")
    try:
        running.processAllAvailable()
        append_csv(odd.select("payment_method", "amount", "order_id"), f"{folder}/in")
        run_available(table.append_flow(spark, [f"{folder}/in"]))
        running.processAllAvailable()
    finally:
        running.stop()
    return target.read(spark).select("order_id", "amount", "payment_method")


def _renamed(spark, folder: str, rename: Callable[[int], str], age_days: int = 0) -> None:
    """Give the files of a folder other names, and another age."""
    jvm = spark._jvm.org.apache.hadoop.fs
    files = jvm.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(str(f.getPath().getName()) for f in files.listStatus(jvm.Path(folder)))
    for n, name in enumerate(p for p in parts if p.startswith("part-")):
        new = jvm.Path(jvm.Path(folder), rename(n))
        files.rename(jvm.Path(f"{folder}/{name}"), new)
        if age_days:
            files.setTimes(new, files.getFileStatus(new).getModificationTime() - age_days * 86_400_000, -1)


@query("late_file_ingest")
def late_file_ingest(spark, sf_dir):
    """The second delivery's files are a month older than those that were read before them."""
    even, odd = feeds.orders_feed_halves(*_t(spark, sf_dir, "events"))
    folder = work_dir(spark, "late_files")
    table = RawTable("orders", f"{folder}/table", types=ORDER_TYPES)
    for n, half in enumerate((even, odd)):
        append_csv(half, f"{folder}/part_{n}")
        _renamed(spark, f"{folder}/part_{n}", lambda k: f"region_{k}.csv", 30 * n)
    run_available(table.append_flow(spark, [f"{folder}/part_[0]"]))
    run_available(table.append_flow(spark, [f"{folder}/part_[01]"]))
    return table.read(spark).select(*_typed(odd.schema))


@query("odd_file_names")
def odd_file_names(spark, sf_dir):
    """Names with blanks, brackets, braces and percent signs mean themselves; each file counts once."""
    even, odd = feeds.orders_feed_halves(*_t(spark, sf_dir, "events"))
    folder = work_dir(spark, "odd_names")
    table = RawTable("orders", f"{folder}/table", types=ORDER_TYPES)
    for name, half in (("a", even), ("b", odd)):
        append_csv(half, f"{folder}/{name}")
        _renamed(spark, f"{folder}/{name}", lambda k: f"sales [{k}] {{x}}%20.csv")
    run_available(table.append_flow(spark, [f"{folder}/a", f"{folder}/b"]))
    return table.read(spark).select(*_typed(odd.schema))


@query("bronze_orders_bad_text")
def bronze_orders_bad_text(spark, sf_dir):
    """Declared types: a quantity that is no number breaks its rule and does not stop the feed."""
    feed, folder = _orders_feed(spark, sf_dir), work_dir(spark, "bad_text")
    bad = F.when(F.col("order_id") % 5 == 0, F.lit("many")).otherwise(F.col("quantity").cast("string"))
    append_csv(feed.withColumn("quantity", bad), f"{folder}/in")
    table = RawTable("orders", f"{folder}/table", ORDER_RULES, "", ORDER_TYPES)
    run_available(table.append_flow(spark, [f"{folder}/in"]))
    return table.read(spark).select(*_typed(feed.schema))


# ---- expectations

@query("expect_drop_orders")
def expect_drop_orders(spark, sf_dir):
    return expect_all_or_drop(_orders_feed(spark, sf_dir), ORDER_RULES)


@query("expect_drop_customers")
def expect_drop_customers(spark, sf_dir):
    return expect_all_or_drop(_customers_feed(spark, sf_dir), CUSTOMER_RULES)


@query("expect_drop_products")
def expect_drop_products(spark, sf_dir):
    return expect_all_or_drop(_products_feed(spark, sf_dir).drop("l_shipdate"), PRODUCT_RULES)


@query("expectation_report")
def expectation_report_orders(spark, sf_dir):
    return expectation_report(_orders_feed(spark, sf_dir), ORDER_RULES)


# ---- change feeds and duplicates

@query("change_feed")
def change_feed(spark, sf_dir):
    return _ntz(feeds.order_commits(*_t(spark, sf_dir, "events")), ch.COMMIT_TIMESTAMP)


@query("append_only_commits")
def append_only_commits(spark, sf_dir):
    feed = feeds.order_commits(*_t(spark, sf_dir, "events"))
    return _ntz(ch.append_only(feed, "commit"), ch.COMMIT_TIMESTAMP)


@query("append_only_rows")
def append_only_rows(spark, sf_dir):
    feed = feeds.order_commits(*_t(spark, sf_dir, "events"))
    return _ntz(ch.append_only(feed, "row"), ch.COMMIT_TIMESTAMP)


@query("dedup_full_row")
def dedup_full_row(spark, sf_dir):
    """The whole feed was delivered twice."""
    feed = _orders_feed(spark, sf_dir)
    return feed.unionByName(feed).dropDuplicates()


@query("dedup_within_commit")
def dedup_within_commit(spark, sf_dir):
    """The whole feed came twice in commit 1 and twice again in commit 2: one copy of each commit stays."""
    events, = _t(spark, sf_dir, "events")
    feed = events.select(*feeds.order_columns(), "ts")
    first, second = [ch.as_change_feed(feed, F.lit(v), F.col("ts")).drop("ts") for v in (1, 2)]
    copies = first.unionByName(first).unionByName(second).unionByName(second)
    return _ntz(ch.dedup_within_commit(copies), ch.COMMIT_TIMESTAMP)


@query("dedup_stream_copies")
def dedup_stream_copies(spark, sf_dir):
    """The whole feed comes in a first micro-batch, and half of it again in a second one."""
    feed = feeds.orders_feed(*_t(spark, sf_dir, "events")).join(
        _t(spark, sf_dir, "events")[0].select(F.col("event_id").alias("order_id"), F.col("ts").cast("timestamp").alias("at")), "order_id")
    folder = work_dir(spark, "copies")
    for part in (feed, feed.filter(F.col("order_id") % 2 == 0)):
        part.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(feed.schema).options(**ANY_AGE).parquet(f"{folder}/in")
        once = ch.dedup_stream(stream, "at", "3650 days").drop("at")
        run_available(append_parquet(once, f"{folder}/out", f"{folder}/checkpoint"))
    return spark.read.schema(once.schema).parquet(f"{folder}/out")


# ---- cleaning

@query("parse_dates_multi_format")
def parse_dates_multi_format(spark, sf_dir):
    return _customers_feed(spark, sf_dir).select(
        "customer_id", F.col("date_of_birth").alias("raw"), parse_date("date_of_birth").alias("parsed"))


@query("parse_timestamps_multi_format")
def parse_timestamps_multi_format(spark, sf_dir):
    raw = F.when(F.col("order_id") % 4 == 3, F.substring("order_date", 1, 10)).otherwise(F.col("order_date"))
    rows = _orders_feed(spark, sf_dir).select("order_id", raw.alias("raw"))
    return _ntz(rows.withColumn("parsed", parse_timestamp("raw")), "parsed")


@query("clean_customers")
def clean_customers_feed(spark, sf_dir):
    return clean_customers(expect_all_or_drop(_customers_feed(spark, sf_dir), CUSTOMER_RULES))


@query("clean_orders")
def clean_orders_feed(spark, sf_dir):
    feed = expect_all_or_drop(_orders_feed(spark, sf_dir), ORDER_RULES)
    return _ntz(clean_orders(feed), "Order_date")


@query("clean_products")
def clean_products_feed(spark, sf_dir):
    feed = _products_feed(spark, sf_dir).drop("l_shipdate")
    return clean_products(expect_all_or_drop(feed, PRODUCT_RULES))


# ---- slowly changing dimensions

def _customer_updates(spark, sf_dir):
    return feeds.customer_updates(_customers_feed(spark, sf_dir), *_t(spark, sf_dir, "orders"))


@query("scd1_customers")
def scd1_customers(spark, sf_dir):
    return scd.scd1(_customer_updates(spark, sf_dir), ["customer_id"])


@query("scd1_orders")
def scd1_orders(spark, sf_dir):
    return scd.scd1(feeds.order_updates(*_t(spark, sf_dir, "events")), ["order_id"])


@query("scd_out_of_order")
def scd_out_of_order(spark, sf_dir):
    """All newest deliveries arrive first and the oldest last; the merge target still ends the same."""
    events, = _t(spark, sf_dir, "events")
    target = MergeTarget("orders", work_dir(spark, "reverse"), ("order_id",))
    for version, delivery in enumerate((2, 1, 0)):
        target.merge(feeds.order_updates(events.filter(F.col("event_id") % 3 == delivery)), version)
    return target.read(spark)


@query("scd1_with_deletes")
def scd1_with_deletes(spark, sf_dir):
    return scd.scd1(feeds.order_updates(*_t(spark, sf_dir, "events")), ["order_id"],
                    delete_when=F.col("payment_method") == "error")


def _intervals(df):
    return _ntz(df, scd.START_AT, scd.END_AT)


@query("scd2_history")
def scd2_history(spark, sf_dir):
    return _intervals(_history(spark, sf_dir))


@query("scd2_change_feed")
def scd2_change_feed(spark, sf_dir):
    """Prices come in three deliveries, the middle of every product's history last. The changes that the type 2 table
    publishes add up to the whole history."""
    updates = feeds.product_updates(*_t(spark, sf_dir, "lineitem", "part"))
    rows = tidy_products(expect_all_or_drop(updates, PRODUCT_RULES))
    target, part = MergeTarget("products", work_dir(spark, "versions"), ("product_id",), scd_type=2), F.col(ch.COMMIT_VERSION) % 3
    for version, delivery in enumerate((2, 0, 1)):
        target.merge(rows.filter(F.pmod(part, F.lit(3)) == delivery), version)
    return _intervals(target.rebuild(target.feed(spark)))


@query("scd2_current")
def scd2_current(spark, sf_dir):
    return _intervals(scd.current(_history(spark, sf_dir)))


@query("scd2_first_start")
def scd2_first_start(spark, sf_dir):
    return _ntz(_intervals(scd.with_first_start(_history(spark, sf_dir), "product_id")), "min_start")


@query("scd2_history_heavy")
def scd2_history_heavy(spark, sf_dir):
    """All products count as heavy: their timelines are cut into ranges of a few rows."""
    updates = feeds.product_updates(*_t(spark, sf_dir, "lineitem", "part"))
    rows = tidy_products(expect_all_or_drop(updates, PRODUCT_RULES))
    return _intervals(scd.scd2(rows, ["product_id"], max_group_rows=6))


@query("price_change_direction")
def price_change_direction(spark, sf_dir):
    return _ntz(gold.price_changes(_history(spark, sf_dir)), scd.START_AT).select(
        "product_id", "price", scd.START_AT, "prev_price", "price_direction")


@query("demand_change_direction")
def demand_change_direction(spark, sf_dir):
    """Units sold per payment method and day, against the day before."""
    daily = (_orders(spark, sf_dir).filter(F.col("Order_date").isNotNull())
             .groupBy("payment_method", F.date_trunc("day", "Order_date").alias("day"))
             .agg(F.sum("quantity").alias("current_demand")))
    rows = with_previous(daily, ["payment_method"], "day", F.col("current_demand"), "p")
    rows = rows.withColumn("prev_demand", F.coalesce("p.value", "current_demand")).drop("p")
    return _ntz(rows.withColumn("demand_direction", direction(F.col("current_demand"), F.col("prev_demand"))),
                "day")


# ---- joins

@query("stream_static_join_customer")
def stream_static_join_customer(spark, sf_dir):
    customers = _stored(spark, _customers(spark, sf_dir).select(
        "customer_id", "customer_name", "city", "state", "gender"), "customers")
    joined = _order_stream(spark, sf_dir).join(customers, "customer_id").select(
        "order_id", "customer_id", "customer_name", "city", "state", "gender", "amount")
    return _streamed(spark, joined, "join")


@query("stream_static_join_product")
def stream_static_join_product(spark, sf_dir):
    products = _current_table(spark, sf_dir).select("product_id", "product_name", "category", "price")
    joined = _order_stream(spark, sf_dir).join(products, "product_id").select(
        "order_id", "product_id", "product_name", "category", "price", "quantity")
    return _streamed(spark, joined, "join")


def _hot(orders: DataFrame, column: str, value: str) -> DataFrame:
    """A third of the orders has the same customer or product."""
    return orders.withColumn(column, F.when(F.col("order_id") % 3 == 0, F.lit(value)).otherwise(F.col(column)))


@query("stream_static_join_hot_key")
def stream_static_join_hot_key(spark, sf_dir):
    customers = _stored(spark, _customers(spark, sf_dir).select("customer_id", "customer_name", "city"), "customers")
    orders = _hot(_order_stream(spark, sf_dir), "customer_id", "CUST1").select("order_id", "customer_id", "amount")
    folder = work_dir(spark, "hot_join")
    run_available(enrich_commits(orders, lambda _: customers, "customer_id", folder, max_key_rows=50))
    return spark.read.parquet(f"{folder}/enriched").select("order_id", "customer_id", "customer_name", "city", "amount")


def _enriched_stream(spark, orders, dimension, key, max_key_rows):
    """Orders that met the dimension in their micro-batch, as a stream that carries its attributes."""
    folder = work_dir(spark, "enriched")
    run_available(enrich_commits(orders, lambda _: dimension, key, folder, max_key_rows))
    return stream_commits(spark, folder, orders.join(dimension, key).schema)


@query("customer_behavior_hot_key")
def customer_behavior_hot_key(spark, sf_dir):
    attributes = ["customer_name", "city", "state", "gender"]
    customers = _stored(spark, _customers(spark, sf_dir).select("customer_id", *attributes), "customers")
    orders = _hot(_order_stream(spark, sf_dir), "customer_id", "CUST1")
    rows = gold.customer_behavior(_enriched_stream(spark, orders, customers, "customer_id", 50), None)
    return _streamed(spark, rows, "behavior")


@query("product_performance_hot_key")
def product_performance_hot_key(spark, sf_dir):
    products = _current_table(spark, sf_dir).select("product_id", "product_name", "category", "price")
    orders = _hot(_order_stream(spark, sf_dir), "product_id", "PROD1")
    rows = gold.product_performance(_enriched_stream(spark, orders, products, "product_id", 50), None)
    return _streamed(spark, rows, "performance")


@query("enrich_changing_dimension")
def enrich_changing_dimension(spark, sf_dir):
    """The dimension changes between two micro-batches, and the first of them is repeated after the change, as after a
    failure before its end was noted down: it meets the dimension that it met before."""
    events, = _t(spark, sf_dir, "events")
    folder = work_dir(spark, "changing")
    customers = MergeTarget("customers", f"{folder}/customers", ("customer_id",), publish=False)
    state = _customers(spark, sf_dir).select("customer_id", "city")

    def report(version: int, rows: DataFrame) -> None:
        customers.merge(ch.as_change_feed(rows, F.lit(version), F.timestamp_seconds(F.lit(version))), version)

    halves = [tidy_orders(expect_all_or_drop(half, ORDER_RULES)).select("order_id", "customer_id", "amount")
              for half in feeds.orders_feed_halves(events)]

    def run() -> None:
        arriving = spark.readStream.schema(halves[0].schema).options(**ANY_AGE).parquet(f"{folder}/in")
        run_available(enrich_commits(arriving, customers, "customer_id", f"{folder}/joined"))

    report(0, state)
    halves[0].write.parquet(f"{folder}/in")
    run()
    report(1, state.withColumn("city", F.concat(F.lit("new "), F.col("city"))))
    for lost in ("checkpoint/commits/0", "checkpoint/commits/.0.crc", "enriched/_commit_version=0"):
        remove_path(spark, f"{folder}/joined/{lost}")
    run()
    halves[1].write.mode("append").parquet(f"{folder}/in")
    run()
    return spark.read.parquet(f"{folder}/joined/enriched").select("order_id", "customer_id", "amount", "city")


def _temporal(spark, sf_dir, before_first, **limits):
    versions = _history_table(spark, sf_dir).select("product_id", "price", scd.START_AT, scd.END_AT)
    joined = as_of_version_join(_sales(spark, sf_dir), versions, "product_id", "Order_date", before_first,
                                sized_by=_product_keys(*_t(spark, sf_dir, "lineitem")), **limits)
    return _ntz(_intervals(joined), "Order_date")


@query("temporal_join_strict")
def temporal_join_strict(spark, sf_dir):
    return _temporal(spark, sf_dir, "drop")


@query("temporal_join_fallback")
def temporal_join_fallback(spark, sf_dir):
    return _temporal(spark, sf_dir, "earliest")


@query("temporal_join_sweep")
def temporal_join_sweep(spark, sf_dir):
    """No version list is short enough to be probed: facts are placed on the timeline of their key in one sweep."""
    return _temporal(spark, sf_dir, "earliest", max_versions_to_probe=0)


@query("temporal_join_crowded")
def temporal_join_crowded(spark, sf_dir):
    """Every product has too many sales for a task: distinct times are swept in ranges."""
    return _temporal(spark, sf_dir, "earliest", max_group_rows=12)


# ---- event time

def _event_windows(events):
    totals = (events.withWatermark("at", gold.WATERMARK)
              .groupBy(F.window("at", gold.WINDOW), "event_type")
              .agg(F.count(F.lit(1)).alias("n"), F.sum(exact(F.col("value"))).alias("money")))
    return totals.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                         F.col("window.end").cast("timestamp_ntz").alias("window_end"), "event_type", "n",
                         as_amount(F.col("money")).alias("total"))


@query("tumbling_window_agg")
def tumbling_window_agg(spark, sf_dir):
    events = feeds.stream_table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    return _streamed(spark, _event_windows(events), "windows")


@query("late_data_drop")
def late_data_drop(spark, sf_dir):
    """The table arrives in three parts by time; the last also brings half of the first part once more."""
    events, = _t(spark, sf_dir, "events")
    events = events.select(F.col("ts").cast("timestamp").alias("at"), "event_type", "value")
    folder = work_dir(spark, "late")
    first, last = events.agg(F.min("at"), F.max("at")).first()
    part, age = (last - first) / 3, F.col("at")
    parts = [events.filter(age < first + part), events.filter((age >= first + part) & (age < last - part)),
             events.filter(age >= last - part).unionByName(events.filter(age < first + part / 2))]
    for part in parts:
        part.write.mode("append").parquet(f"{folder}/in")
        windows = _event_windows(spark.readStream.schema(events.schema).options(**ANY_AGE).parquet(f"{folder}/in"))
        run_available(append_parquet(windows, f"{folder}/out", f"{folder}/checkpoint"))
    return spark.read.schema(windows.schema).parquet(f"{folder}/out")


@query("null_event_time")
def null_event_time(spark, sf_dir):
    """Orders with an unreadable date are in no window."""
    windows = (gold.with_event_time(_order_stream(spark, sf_dir))
               .groupBy(F.window(gold.EVENT_TIME, gold.WINDOW)).agg(F.count(F.lit(1)).alias("n"))
               .select(*gold.window_bounds(), "n"))
    return _streamed(spark, windows, "nulls")


@query("customer_segment")
def customer_segment_of_day(spark, sf_dir):
    orders, = _t(spark, sf_dir, "orders")
    spent = orders.groupBy(F.concat(F.lit("CUST"), F.col("o_custkey").cast("string")).alias("customer_id"),
                           "o_orderdate").agg(
        F.count(F.lit(1)).alias("order_count"),
        as_amount(F.sum(exact(F.col("o_totalprice") / 40))).alias("total_spent"))
    return spent.drop("o_orderdate").withColumn("customer_segment", customer_segment(F.col("total_spent")))


# ---- business results

@query("customer_behavior")
def customer_behavior(spark, sf_dir):
    rows = gold.customer_behavior(_order_stream(spark, sf_dir),
                                  _stored(spark, _customers(spark, sf_dir), "customers"))
    return _streamed(spark, rows, "behavior")


@query("product_performance")
def product_performance(spark, sf_dir):
    rows = gold.product_performance(_order_stream(spark, sf_dir),
                                    _current_table(spark, sf_dir))
    return _streamed(spark, rows, "performance")


@query("customer_behavior_batch")
def customer_behavior_batch(spark, sf_dir):
    return gold.customer_behavior(_orders(spark, sf_dir), _customers(spark, sf_dir))


@query("product_performance_batch")
def product_performance_batch(spark, sf_dir):
    return gold.product_performance(_orders(spark, sf_dir), _history(spark, sf_dir))


@query("payment_analysis")
def payment_analysis(spark, sf_dir):
    return gold.payment_analysis(_orders(spark, sf_dir))


@query("payment_analysis_fractions")
def payment_analysis_fractions(spark, sf_dir):
    """Amounts with five decimals."""
    orders = _orders(spark, sf_dir).withColumn("amount", F.col("amount") / 1000)
    return gold.payment_analysis(orders).select("payment_method", "total_revenue", "total_orders", "avg_transaction_value")


@query("price_demand_analysis")
def price_demand_analysis(spark, sf_dir):
    return gold.price_demand_analysis(_sales(spark, sf_dir), _history_table(spark, sf_dir),
                                      sized_by=_product_keys(*_t(spark, sf_dir, "lineitem")))


@query("price_demand_any_product_fallback")
def price_demand_any_product_fallback(spark, sf_dir):
    return gold.price_demand_any_product_fallback(_sales(spark, sf_dir), _history_table(spark, sf_dir),
                                                  sized_by=_product_keys(*_t(spark, sf_dir, "lineitem")))


@query("price_demand_any_product_fallback_heavy")
def price_demand_any_product_fallback_heavy(spark, sf_dir):
    """All products count as heavy, and the running total over time is cut into ranges."""
    return gold.price_demand_any_product_fallback(_sales(spark, sf_dir), _history_table(spark, sf_dir), max_group_rows=20)


@query("customer_behavior_rewrites")
def customer_behavior_rewrites(spark, sf_dir):
    """The second of three deliveries also amends orders of the first. Its commit rewrites rows, so the stream of appended
    orders passes over it."""
    feed = _orders_feed(spark, sf_dir)
    part, orders = F.col("order_id") % 3, MergeTarget("orders", work_dir(spark, "rewritten"), ("order_id",))
    amended = feed.filter(F.col("order_id") % 30 == 3).withColumn("payment_method", F.lit("amended"))
    for version, rows in enumerate((feed.filter(part == 0), feed.filter(part == 1).unionByName(amended), feed.filter(part == 2))):
        commit = ch.as_change_feed(expect_all_or_drop(rows, ORDER_RULES), F.lit(version), F.timestamp_seconds(F.lit(version)))
        orders.merge(tidy_orders(commit), version)
    customers = _stored(spark, _customers(spark, sf_dir), "customers")
    return _streamed(spark, gold.customer_behavior(orders.stream_appends(spark), customers), "behavior")


@query("product_performance_incremental")
def product_performance_incremental(spark, sf_dir):
    """Products come from a type 2 table that was merged from two deliveries, the later half of the changes first."""
    updates = feeds.product_updates(*_t(spark, sf_dir, "lineitem", "part"))
    products = MergeTarget("products", work_dir(spark, "products"), ("product_id",), scd_type=2, publish=False)
    late = F.col(ch.COMMIT_VERSION) % 2 == 0
    for version, rows in enumerate((updates.filter(late), updates.filter(~late))):
        products.merge(tidy_products(expect_all_or_drop(rows, PRODUCT_RULES)), version)
    current = _stored(spark, products.read(spark), "products_now")
    return _streamed(spark, gold.product_performance(_order_stream(spark, sf_dir), current), "performance")


@query("customer_behavior_end_to_end")
def customer_behavior_end_to_end(spark, sf_dir):
    """From CSV files over raw tables, cleaning and merge targets to the windowed stream."""
    raw_orders = _order_table(spark, sf_dir, ORDER_RULES)
    folder = work_dir(spark, "medallion")
    raw_customers = RawTable("customers", f"{folder}/raw_customers", CUSTOMER_RULES, types=CUSTOMER_TYPES)
    append_csv(_customers_feed(spark, sf_dir), f"{folder}/customers_in")
    run_available(raw_customers.append_flow(spark, [f"{folder}/customers_in"]))

    customers = MergeTarget("customers", f"{folder}/customers", ("customer_id",), publish=False)
    run_available(customers.apply_changes(raw_customers, tidy_customers, spark))
    orders = MergeTarget("orders", f"{folder}/orders", ("order_id",))
    run_available(orders.apply_changes(raw_orders, tidy_orders, spark))

    rows = gold.customer_behavior(orders.stream_appends(spark), _stored(spark, customers.read(spark), "dim"))
    run_available(append_parquet(rows, f"{folder}/out", f"{folder}/out_checkpoint"))
    return spark.read.schema(rows.schema).parquet(f"{folder}/out")
