"""Business results on top of the cleaned and versioned tables.

Money follows the ``amount`` column unless told otherwise. The two windowed results are written once and
run on a stream (a window appears when the watermark has passed its end) or on a batch (all windows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import as_amount, average_half_up, customer_segment, direction, exact, finite
from ..operators.ordered import (MAX_GROUP_ROWS, heavy_or_none, largest_group, running_total_before,
                                 with_previous, written, written_alone)
from ..operators.scd import END_AT, START_AT, current, with_first_start
from ..operators.temporal import MAX_VERSIONS_TO_PROBE, as_of_version_join

# Length of the windows and how late a row may come.
WINDOW, WATERMARK = "5 minutes", "2 minutes"
EVENT_TIME = "Order_timestamp"


def with_event_time(orders: DataFrame, delay: str = WATERMARK) -> DataFrame:
    return (orders.withColumn(EVENT_TIME, F.col("Order_date").cast("timestamp"))
                  .withWatermark(EVENT_TIME, delay))


def window_bounds() -> list[Column]:
    return [F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end")]


def _per_window(orders: DataFrame, dimension: DataFrame | None, key: str, attributes: list[str],
                totals: list[Column], window: str) -> DataFrame:
    """Window totals per key, enriched with the dimension's attributes.

    A stream joins first, so that a row meets the dimension as it was when the row arrived. A batch sees one
    state of the dimension, whose key is unique, so it can add up first and join the far smaller totals.
    Without a dimension the orders carry the attributes already.
    """
    slot = F.window(EVENT_TIME, window)
    if dimension is None:
        return orders.groupBy(slot, key, *attributes).agg(*totals)
    dimension = dimension.select(key, *attributes)
    if orders.isStreaming:
        return orders.join(dimension, key, "inner").groupBy(slot, key, *attributes).agg(*totals)
    return orders.groupBy(slot, key).agg(*totals).join(dimension, key, "inner")


def customer_behavior(orders: DataFrame, customers: DataFrame | None, window: str = WINDOW,
                      delay: str = WATERMARK, amount: str = "amount") -> DataFrame:
    spent = exact(F.col(amount))
    totals = [F.sum(spent).alias("money"), F.count(spent).alias("priced"),
              F.count(F.lit(1)).alias("purchase_count"),
              F.max(F.to_date("Order_date")).alias("last_purchase_date")]
    attributes = ["customer_name", "city", "state", "gender"]
    rows = _per_window(with_event_time(orders, delay), customers, "customer_id", attributes, totals, window)
    total = as_amount(F.col("money"))
    return rows.select(
        *window_bounds(), "customer_id", *attributes,
        total.alias("total_spent"), "purchase_count",
        average_half_up(F.col("money"), F.col("priced")).alias("avg_purchase_value"),
        "last_purchase_date", customer_segment(total).alias("customer_segment"))


def product_performance(orders: DataFrame, product_history: DataFrame | None, window: str = WINDOW,
                        delay: str = WATERMARK, amount: str = "amount") -> DataFrame:
    products = None if product_history is None else current(product_history)
    earned = exact(F.col(amount))
    totals = [F.sum(earned).alias("money"), F.count(earned).alias("priced"),
              F.sum(F.col("quantity").cast("int")).alias("units_sold"),
              F.count(F.lit(1)).alias("order_frequency")]
    attributes = ["product_name", "category", "price"]
    rows = _per_window(with_event_time(orders, delay), products, "product_id", attributes, totals, window)
    return rows.select(
        *window_bounds(), "product_id", *attributes,
        as_amount(F.col("money")).alias("total_revenue"), "units_sold", "order_frequency",
        average_half_up(F.col("money"), F.col("priced")).alias("avg_revenue_per_order"))


def payment_analysis(orders: DataFrame, amount: str = "amount") -> DataFrame:
    value, money = finite(F.col(amount)), exact(F.col(amount))
    totals = orders.groupBy("payment_method").agg(
        F.sum(money).alias("money"), F.count(money).alias("priced"),
        F.count("order_id").alias("total_orders"),
        F.max(value).alias("max_transaction"), F.min(value).alias("min_transaction"))
    return totals.select(
        "payment_method", as_amount(F.col("money")).alias("total_revenue"), "total_orders",
        average_half_up(F.col("money"), F.col("priced")).alias("avg_transaction_value"),
        "max_transaction", "min_transaction")


def price_changes(product_history: DataFrame, heavy: DataFrame | None = None, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Every product version with the price before it and the direction of the change."""
    rows = with_previous(product_history, ["product_id"], START_AT, F.col("price"), "__previous", heavy, max_group_rows)
    # A previous price of NULL falls back to the own price, like a missing one.
    rows = rows.withColumn("prev_price", F.coalesce("__previous.value", "price")).drop("__previous")
    return rows.withColumn("price_direction", direction(F.col("price").cast("double"),
                                                        F.col("prev_price").cast("double")))


def units_per_time(sales: DataFrame) -> DataFrame:
    """Sales added up per product and time, before they meet the versions."""
    return (sales.groupBy("product_id", "Order_date")
                 .agg(F.sum(F.col("quantity").cast("int")).alias("__units")))


def demand_changes(demand: DataFrame, heavy: DataFrame | None = None, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Each selling period with the demand of the product's selling period before it."""
    rows = with_previous(demand, ["product_id"], START_AT, F.col("current_demand"), "__previous", heavy, max_group_rows)
    rows = rows.withColumn("prev_demand", F.coalesce("__previous.value", "current_demand"))
    return rows.drop("__previous").withColumn(
        "demand_direction", direction(F.col("current_demand"), F.col("prev_demand")))


def _priced_versions(product_history: DataFrame, heavy: DataFrame | None, max_group_rows: int) -> DataFrame:
    def rows() -> DataFrame:
        return price_changes(product_history, heavy, max_group_rows).select(
            "product_id", "category", F.col("price").cast("double").alias("current_price"),
            F.col("prev_price").cast("double").alias("prev_price"), "price_direction", START_AT, END_AT)

    return rows() if heavy is None else written_alone(product_history.sparkSession, rows, "priced")


def _price_demand_report(demand: DataFrame, heavy: DataFrame | None, max_group_rows: int) -> DataFrame:
    # The product and the start make the order total; sorting by few categories alone would leave
    # each category to one task.
    return (demand_changes(demand, heavy, max_group_rows).orderBy("category", "product_id", START_AT)
            .select("category", F.round("prev_price", 2).alias("prev_price"),
                    F.round("current_price", 2).alias("current_price"), "price_direction",
                    "prev_demand", "current_demand", "demand_direction"))


def price_demand_analysis(sales: DataFrame, product_history: DataFrame, before_first: str = "earliest",
                          max_versions_to_probe: int = MAX_VERSIONS_TO_PROBE,
                          max_group_rows: int = MAX_GROUP_ROWS, sized_by: DataFrame | None = None) -> DataFrame:
    """Units sold in each price period against the product's period before; periods without sales are left out.

    The history is counted once: demand has at most one row per version, so one measure serves all steps.
    ``sized_by`` is as in :func:`as_of_version_join`.
    """
    largest = largest_group(product_history, ["product_id"])
    heavy = heavy_or_none(product_history, ["product_id"], max_group_rows, largest)
    joined = as_of_version_join(units_per_time(sales), _priced_versions(product_history, heavy, max_group_rows), "product_id",
                                "Order_date", before_first, max_versions_to_probe, max_group_rows, largest,
                                sales if sized_by is None else sized_by)
    demand = (joined.groupBy("product_id", "category", "current_price", "prev_price", "price_direction", START_AT)
                    .agg(F.sum("__units").alias("current_demand")))
    return _price_demand_report(demand, heavy, max_group_rows)


def price_demand_any_product_fallback(sales: DataFrame, product_history: DataFrame,
                                      max_versions_to_probe: int = MAX_VERSIONS_TO_PROBE,
                                      max_group_rows: int = MAX_GROUP_ROWS,
                                      sized_by: DataFrame | None = None) -> DataFrame:
    """The variant in which the fallback to a first version does not ask for the same product.

    A product's first version then also counts every sale, of any product, that came before it. Joining
    those pairs would grow with the square of the data; their sum is a running total over time.
    """
    largest = largest_group(product_history, ["product_id"])
    heavy = heavy_or_none(product_history, ["product_id"], max_group_rows, largest)
    spark = sales.sparkSession

    def demand() -> DataFrame:
        versions = _priced_versions(product_history, heavy, max_group_rows)
        units = written(units_per_time(sales), "units")
        own = written_alone(spark, lambda: as_of_version_join(
            units, versions.select("product_id", START_AT, END_AT), "product_id", "Order_date", "drop", max_versions_to_probe,
            max_group_rows, largest, sales if sized_by is None else sized_by)
            .groupBy("product_id", START_AT).agg(F.sum("__units").alias("__own")), "own")

        versions = with_first_start(versions, "product_id", "__first", heavy)
        is_first = F.col(START_AT) == F.col("__first")
        starts = versions.filter(is_first).select(F.col(START_AT).alias("Order_date"))
        earlier = running_total_before(units, starts, "Order_date", "__units", max_group_rows).select(
            F.col("Order_date").alias("__at"), "total_before", "rows_before")
        return (versions.join(own, ["product_id", START_AT], "left")
                .join(earlier, (F.col(START_AT) == F.col("__at")) & is_first, "left")
                .filter(F.col("__own").isNotNull() | (F.col("rows_before") > 0))
                .withColumn("current_demand",
                            F.coalesce("__own", F.lit(0)) + F.coalesce("total_before", F.lit(0))))

    # One table after the other, so that only what is still read takes up disk.
    return _price_demand_report(written_alone(spark, demand, "demand"), heavy, max_group_rows)
