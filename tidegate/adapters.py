"""The retail feeds, derived from the star-schema test tables. Every feed uses all rows of its tables.

Bad values (missing or unreadable dates, missing ids, zero quantities, negative amounts) are planted by
row number, as a raw feed would contain them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .operators.changes import as_change_feed
from .sources.csv_feed import ANY_AGE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """A file that cannot be split keeps one core busy and the others idle, so its rows are dealt out.

    Only a table with fewer input splits than the cluster has cores is dealt out; a large one never is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, df.columns[0]) if df.rdd.getNumPartitions() < cores else df


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream. The glob fits one file as well as a folder of files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).options(**ANY_AGE).parquet(f"{sf_dir}/[{name[0]}]{name[1:]}.parquet")


def _pick(selector: Column, *values) -> Column:
    """values[i] where the selector is i."""
    chosen = F.when(selector == 0, values[0])
    for i, value in enumerate(values[1:], start=1):
        chosen = chosen.when(selector == i, value)
    return chosen


def _in_notation(iso: Column, selector: Column) -> Column:
    """ISO text, rewritten with slashes or day first."""
    day_first = F.concat(F.substring(iso, 9, 2), F.lit("/"), F.substring(iso, 6, 2), F.lit("/"),
                         F.substring(iso, 1, 4), F.substring(iso, 11, 9))
    return _pick(selector, iso, F.translate(iso, "-", "/"), day_first)


def key_of(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def order_columns() -> list[Column]:
    n = F.col("event_id")
    text = _in_notation(F.date_trunc("second", F.col("ts")).cast("string"), n % 3)
    return [
        n.alias("order_id"),
        F.when(n % 13 != 12, key_of("CUST", F.col("user_id"))).alias("customer_id"),
        F.when(n % 17 != 16, key_of("PROD", n * 7 % 200)).alias("product_id"),
        (n % 9).cast("int").alias("quantity"),
        F.col("event_type").alias("payment_method"),
        F.when(n % 11 == 10, -F.col("value")).otherwise(F.col("value")).alias("amount"),
        F.when(n % 10 == 9, None).when(n % 23 == 22, "unknown").otherwise(text).alias("order_date"),
        _pick(n % 3, F.lit("Online"), F.lit("Store"), F.lit("Mobile App")).alias("sales_channel")]


def orders_feed(events: DataFrame) -> DataFrame:
    return events.select(*order_columns())


def orders_feed_halves(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two regional feeds; together they are the whole feed."""
    feed = orders_feed(events)
    return feed.filter(F.col("order_id") % 2 == 0), feed.filter(F.col("order_id") % 2 == 1)


def order_commits(events: DataFrame) -> DataFrame:
    """The order feed as a change feed with 100 rows to a commit; some rows are updates."""
    feed = events.select(*order_columns(), "ts")
    kind = F.when(F.col("order_id") % 997 == 0, "update_postimage").otherwise("insert")
    return as_change_feed(feed, F.floor(F.col("order_id") / 100), F.col("ts"), kind).drop("ts")


def order_updates(events: DataFrame) -> DataFrame:
    """Three deliveries per order id, the later ones updates."""
    feed = events.select(*order_columns(), "ts").withColumn("order_id", F.floor(F.col("order_id") / 3))
    return as_change_feed(feed, F.floor(F.col("order_id") / 300), F.col("ts")).drop("ts")


def customers_feed(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    rows = customer.join(places, customer.c_nationkey == places.n_nationkey)
    n = F.col("c_custkey")
    born = F.date_add(F.lit("1960-01-01").cast("date"), (n % 14600).cast("int"))
    street = F.when(n % 10 != 5, key_of("Road ", n % 100))
    locality = key_of("Sector ", n % 20)
    code = (n % 10000 + 750000).cast("int")
    return rows.select(
        key_of("CUST", n).alias("customer_id"),
        F.concat(F.lit("  "), F.when(n % 2 == 0, F.lower("c_name")).otherwise(F.col("c_name")),
                 F.lit(" ")).alias("customer_name"),
        F.when(n % 10 != 3, F.concat(F.lit("c"), n.cast("string"), F.lit("@example.org"))).alias("email"),
        F.concat(F.lit("+91"), (n + 8900000000).cast("string")).alias("phone_number"),
        F.col("c_mktsegment").alias("gender"),
        F.when(n % 10 != 7, _in_notation(born.cast("string"), n % 3)).alias("date_of_birth"),
        street.alias("street_name"), locality.alias("locality"),
        F.col("n_name").alias("city"), F.col("r_name").alias("state"), F.lit("India").alias("country"),
        code.alias("postal_code"),
        F.concat_ws(",", F.coalesce(street, F.lit("None")), locality, "n_name", "r_name", F.lit("India"),
                    code.cast("string")).alias("address"))


def customer_updates(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """A customer reports a new postal code with every order; same-day orders tie in sequence."""
    moves = orders.select(key_of("CUST", F.col("o_custkey")).alias("customer_id"),
                          (F.col("o_orderkey") % 10000 + 750000).cast("int").alias("postal_code"),
                          "o_orderkey", "o_orderdate")
    rows = moves.join(customers.drop("postal_code", "address"), "customer_id")
    feed = rows.select("customer_id", "customer_name", "email", "gender", "date_of_birth", "street_name",
                       "city", "state", "postal_code", "o_orderkey", "o_orderdate")
    return (as_change_feed(feed, F.floor(F.col("o_orderkey") / 1000), F.col("o_orderdate"))
            .drop("o_orderkey", "o_orderdate"))


def products_feed(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Raw product rows: a price seen on a day, in whole hundreds plus 99.99 so that it often stays the same."""
    rows = lineitem.join(part, lineitem.l_partkey == part.p_partkey)
    n, line = F.col("l_partkey"), F.col("l_orderkey")
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    each = F.floor(cents / F.col("l_quantity") / 10000) * 10000 + 9999
    price = each.cast("double") / 100.0
    expires = F.date_add(F.lit("2026-01-01").cast("date"), (n % 365).cast("int"))
    return rows.select(
        key_of("PROD", n).alias("product_id"),
        F.when(n % 29 != 28, F.col("p_name")).alias("product_name"),
        F.when(line % 11 == 10, -price).otherwise(price).alias("price"),
        F.when(n % 31 != 30, F.col("p_type")).alias("category"),
        F.when(line % 10 != 9, _in_notation(expires.cast("string"), n % 3)).alias("expiry_date"),
        "l_shipdate")


def product_updates(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    feed = products_feed(lineitem, part)
    day = F.datediff(F.col("l_shipdate"), F.lit("1995-01-01").cast("date"))
    return as_change_feed(feed, day, F.col("l_shipdate")).drop("l_shipdate")


def sales_feed(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    rows = orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey)
    return rows.select(
        F.col("o_orderkey").alias("order_id"), key_of("PROD", F.col("l_partkey")).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("o_orderdate").cast("timestamp").alias("Order_date"))
