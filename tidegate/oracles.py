"""The same results in DuckDB SQL, written independently from the Spark plans."""

from __future__ import annotations

import re

_NAMES = {
    "orders_feed": """
        SELECT event_id AS order_id,
               CASE WHEN event_id % 13 = 12 THEN NULL ELSE 'CUST' || user_id END AS customer_id,
               CASE WHEN event_id % 17 = 16 THEN NULL ELSE 'PROD' || (event_id * 7 % 200) END AS product_id,
               CAST(event_id % 9 AS INTEGER) AS quantity,
               event_type AS payment_method,
               CASE WHEN event_id % 11 = 10 THEN -value ELSE value END AS amount,
               CASE WHEN event_id % 10 = 9 THEN NULL
                    WHEN event_id % 23 = 22 THEN 'unknown'
                    WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                    WHEN event_id % 3 = 1 THEN strftime(ts, '%Y/%m/%d %H:%M:%S')
                    ELSE strftime(ts, '%d/%m/%Y %H:%M:%S') END AS order_date,
               CASE event_id % 3 WHEN 0 THEN 'Online' WHEN 1 THEN 'Store' ELSE 'Mobile App' END AS sales_channel,
               ts
        FROM events""",
    "orders_bronze": """
        SELECT * FROM orders_feed WHERE quantity > 0 AND amount > 0 AND order_date IS NOT NULL""",
    "orders_clean": """
        SELECT order_id, customer_id, product_id, quantity, payment_method, amount,
               coalesce(try_strptime(order_date, '%Y-%m-%d %H:%M:%S'),
                        try_strptime(order_date, '%Y/%m/%d %H:%M:%S'),
                        try_strptime(order_date, '%d/%m/%Y %H:%M:%S')) AS order_time,
               sales_channel, amount * quantity AS total_amount, ts
        FROM orders_bronze WHERE customer_id IS NOT NULL AND product_id IS NOT NULL""",
    "orders_timed": """
        SELECT *, time_bucket(INTERVAL 5 MINUTE, order_time) AS window_start,
               time_bucket(INTERVAL 5 MINUTE, order_time) + INTERVAL 5 MINUTE AS window_end,
               CAST(round(amount * 100) AS BIGINT) AS cents
        FROM orders_clean WHERE order_time IS NOT NULL""",
    "closed": """
        SELECT * FROM orders_timed
        WHERE window_end <= (SELECT max(order_time) FROM orders_clean) - INTERVAL 2 MINUTE""",
    "appended": """
        SELECT * FROM orders_timed WHERE order_id % 3 <> 1""",
    "appended_closed": """
        SELECT * FROM appended
        WHERE window_end <= (SELECT max(order_time) FROM appended) - INTERVAL 2 MINUTE""",
    "hot_customers": """
        SELECT * REPLACE (CASE WHEN order_id % 3 = 0 THEN 'CUST1' ELSE customer_id END AS customer_id) FROM orders_clean""",
    "hot_customers_closed": """
        SELECT * REPLACE (CASE WHEN order_id % 3 = 0 THEN 'CUST1' ELSE customer_id END AS customer_id) FROM orders_timed
        WHERE window_end <= (SELECT max(h.order_time) FROM hot_customers h JOIN customers_clean c ON h.customer_id = c.customer_id)
                            - INTERVAL 2 MINUTE""",
    "hot_products_closed": """
        SELECT * REPLACE (CASE WHEN order_id % 3 = 0 THEN 'PROD1' ELSE product_id END AS product_id) FROM orders_timed
        WHERE window_end <= (SELECT max(order_time) FROM orders_clean o JOIN product_history p
                             ON CASE WHEN order_id % 3 = 0 THEN 'PROD1' ELSE o.product_id END = p.product_id AND p.end_at IS NULL)
                            - INTERVAL 2 MINUTE""",
    "customers_feed": """
        SELECT 'CUST' || c_custkey AS customer_id,
               '  ' || CASE WHEN c_custkey % 2 = 0 THEN lower(c_name) ELSE c_name END || ' ' AS customer_name,
               CASE WHEN c_custkey % 10 <> 3 THEN 'c' || c_custkey || '@example.org' END AS email,
               '+91' || (c_custkey + 8900000000) AS phone_number,
               c_mktsegment AS gender,
               CASE WHEN c_custkey % 10 = 7 THEN NULL
                    WHEN c_custkey % 3 = 0 THEN strftime(born, '%Y-%m-%d')
                    WHEN c_custkey % 3 = 1 THEN strftime(born, '%Y/%m/%d')
                    ELSE strftime(born, '%d/%m/%Y') END AS date_of_birth,
               CASE WHEN c_custkey % 10 <> 5 THEN 'Road ' || (c_custkey % 100) END AS street_name,
               'Sector ' || (c_custkey % 20) AS locality,
               n_name AS city, r_name AS state, 'India' AS country,
               CAST(c_custkey % 10000 + 750000 AS INTEGER) AS postal_code,
               CASE WHEN c_custkey % 10 <> 5 THEN 'Road ' || (c_custkey % 100) ELSE 'None' END
                 || ',Sector ' || (c_custkey % 20) || ',' || n_name || ',' || r_name || ',India,'
                 || (c_custkey % 10000 + 750000) AS address
        FROM (SELECT *, DATE '1960-01-01' + CAST(c_custkey % 14600 AS INTEGER) AS born FROM customer) c
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "customers_bronze": """
        SELECT * FROM customers_feed
        WHERE email IS NOT NULL AND date_of_birth IS NOT NULL AND street_name IS NOT NULL""",
    "customers_clean": """
        SELECT * REPLACE (upper(trim(customer_name)) AS customer_name,
               CAST(coalesce(try_strptime(date_of_birth, '%Y-%m-%d'), try_strptime(date_of_birth, '%Y/%m/%d'),
                             try_strptime(date_of_birth, '%d/%m/%Y')) AS DATE) AS date_of_birth)
        FROM customers_bronze""",
    "products_feed": """
        SELECT 'PROD' || l_partkey AS product_id,
               CASE WHEN l_partkey % 29 <> 28 THEN p_name END AS product_name,
               CASE WHEN l_orderkey % 11 = 10 THEN -1 ELSE 1 END *
                 ((floor(floor(l_extendedprice * 100 + 0.5) / l_quantity / 10000) * 10000 + 9999) / 100.0) AS price,
               CASE WHEN l_partkey % 31 <> 30 THEN p_type END AS category,
               CASE WHEN l_orderkey % 10 = 9 THEN NULL
                    WHEN l_partkey % 3 = 0 THEN strftime(expires, '%Y-%m-%d')
                    WHEN l_partkey % 3 = 1 THEN strftime(expires, '%Y/%m/%d')
                    ELSE strftime(expires, '%d/%m/%Y') END AS expiry_date,
               l_shipdate
        FROM (SELECT *, DATE '2026-01-01' + CAST(l_partkey % 365 AS INTEGER) AS expires FROM lineitem) l
        JOIN part ON l_partkey = p_partkey""",
    "products_bronze": """
        SELECT * FROM products_feed
        WHERE category IS NOT NULL AND product_name IS NOT NULL AND price > 0 AND expiry_date IS NOT NULL""",
    "products_clean": """
        SELECT product_id,
               array_to_string(list_transform(string_split(product_name, ' '),
                               lambda w: upper(w[1]) || lower(w[2:])), ' ') AS product_name,
               price, category,
               CAST(coalesce(try_strptime(expiry_date, '%Y-%m-%d'), try_strptime(expiry_date, '%Y/%m/%d'),
                             try_strptime(expiry_date, '%d/%m/%Y')) AS DATE) AS expiry_date,
               l_shipdate
        FROM products_bronze""",
    "product_steps": """
        SELECT product_id, product_name, category, expiry_date, l_shipdate AS as_of, max(price) AS price
        FROM products_clean GROUP BY ALL""",
    "product_history": """
        SELECT product_id, product_name, price, category, expiry_date, as_of AS start_at,
               lead(as_of) OVER (PARTITION BY product_id ORDER BY as_of) AS end_at
        FROM (SELECT *, lag(price) OVER (PARTITION BY product_id ORDER BY as_of) AS before_price
              FROM product_steps)
        WHERE before_price IS DISTINCT FROM price""",
    "sales": """
        SELECT o_orderkey AS order_id, 'PROD' || l_partkey AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity, o_orderdate AS order_time
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "price_steps": """
        SELECT *, coalesce(lag(price) OVER (PARTITION BY product_id ORDER BY start_at), price) AS prev_price,
               min(start_at) OVER (PARTITION BY product_id) AS min_start
        FROM product_history""",
    "order_updates": """
        SELECT * REPLACE (order_id // 3 AS order_id), order_id // 300 AS version
        FROM orders_feed""",
    "customer_updates": """
        SELECT customer_id, customer_name, email, gender, date_of_birth, street_name, city, state,
               CAST(o_orderkey % 10000 + 750000 AS INTEGER) AS postal_code,
               o_orderkey // 1000 AS version, o_orderdate AS as_of
        FROM orders JOIN customers_feed ON customer_id = 'CUST' || o_custkey""",
}


def _with(body: str) -> str:
    """Prefix the named subqueries that ``body`` uses, directly or not."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql):
            if name in _NAMES and name not in needed:
                visit(_NAMES[name])
                needed.append(name)

    visit(body)
    heads = ",\n".join(f"{name} AS ({_NAMES[name]})" for name in needed)
    return f"WITH {heads}\n{body}" if heads else body


_DIRECTION = "CASE WHEN {a} > {b} THEN 'UP' WHEN {a} < {b} THEN 'DOWN' ELSE 'SAME' END"
_PRICE_DIRECTION = _DIRECTION.format(a="price", b="prev_price")
_AVG = "((2 * sum(cents) + count(*)) // (2 * count(*))) / 100.0"
_ORDER_COLUMNS = ("order_id, customer_id, product_id, quantity, payment_method, amount, order_date, "
                  "sales_channel")
_CUSTOMER_COLUMNS = ("customer_id, customer_name, email, phone_number, gender, date_of_birth, street_name, "
                     "locality, city, state, country, postal_code, address")
_CLEAN_CUSTOMER = _CUSTOMER_COLUMNS.replace("date_of_birth", 'date_of_birth AS "Date_of_birth"')
_PRODUCT_COLUMNS = "product_id, product_name, price, category, expiry_date"
_CLEAN_ORDER = ('order_id, customer_id, product_id, quantity, payment_method, amount, '
                'order_time AS "Order_date", sales_channel, total_amount')
_SEGMENT = ("CASE WHEN {t} > 10000 THEN 'Premium' WHEN {t} > 5000 THEN 'Gold' "
            "WHEN {t} > 2000 THEN 'Silver' ELSE 'Bronze' END")


def _behavior(source: str) -> str:
    total = "CAST(sum(cents) AS DOUBLE) / 100.0"
    return f"""
        SELECT window_start, window_end, o.customer_id, c.customer_name, c.city, c.state, c.gender,
               {total} AS total_spent, count(*) AS purchase_count, {_AVG} AS avg_purchase_value,
               max(CAST(order_time AS DATE)) AS last_purchase_date,
               {_SEGMENT.format(t=total)} AS customer_segment
        FROM {source} o JOIN customers_clean c ON o.customer_id = c.customer_id GROUP BY ALL"""


def _performance(source: str) -> str:
    return f"""
        SELECT window_start, window_end, o.product_id, p.product_name, p.category, p.price,
               CAST(sum(cents) AS DOUBLE) / 100.0 AS total_revenue, CAST(sum(quantity) AS BIGINT) AS units_sold,
               count(*) AS order_frequency, {_AVG} AS avg_revenue_per_order
        FROM {source} o JOIN product_history p ON o.product_id = p.product_id AND p.end_at IS NULL
        GROUP BY ALL"""


def _demand(matches: str) -> str:
    demand = _DIRECTION.format(a="current_demand", b="prev_demand")
    return f"""
        SELECT category, round(prev_price, 2) AS prev_price, round(price, 2) AS current_price,
               {_PRICE_DIRECTION} AS price_direction, CAST(prev_demand AS BIGINT) AS prev_demand,
               CAST(current_demand AS BIGINT) AS current_demand, {demand} AS demand_direction
        FROM (SELECT *, coalesce(lag(current_demand) OVER (PARTITION BY product_id ORDER BY start_at),
                                 current_demand) AS prev_demand
              FROM (SELECT product_id, category, price, prev_price, start_at, sum(quantity) AS current_demand
                    FROM ({matches}) GROUP BY ALL))"""


_PERIOD = "p.product_id, p.category, p.price, p.prev_price, p.start_at, o.quantity"
_IN_RANGE = "o.order_time >= p.start_at AND (o.order_time < p.end_at OR p.end_at IS NULL)"
_EARLY = "o.order_time < p.min_start AND p.start_at = p.min_start"
_TEMPORAL = """
        SELECT o.order_id, o.product_id, o.quantity, o.order_time AS "Order_date",
               p.price, p.start_at AS "__START_AT", p.end_at AS "__END_AT"
        FROM sales o JOIN price_steps p ON o.product_id = p.product_id AND ({on})"""

_HISTORY = ('product_id, product_name, price, category, expiry_date, '
            'start_at AS "__START_AT", end_at AS "__END_AT"')


def _scd1(table: str, key: str, columns: str, seq: str, version: str, extra: str = "") -> str:
    order = ", ".join([f"{seq} DESC", f"{version} DESC",
                       *[f"{c} DESC NULLS LAST" for c in columns.replace(" ", "").split(",") if c != key]])
    return f"""
        SELECT {columns} FROM (
            SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS place FROM {table}
            WHERE {key} IS NOT NULL) WHERE place = 1 {extra}"""


_UPDATE_COLUMNS = "customer_id, customer_name, email, gender, date_of_birth, street_name, city, state, postal_code"


def oracle_queries() -> dict[str, str]:
    plain = {
        "csv_roundtrip": f"SELECT {_ORDER_COLUMNS} FROM orders_feed",
        "csv_feed_ingest": f"SELECT {_ORDER_COLUMNS} FROM orders_feed",
        "schema_infer": """
            SELECT * FROM (VALUES ('customer_id', 'string'), ('customer_name', 'string'), ('email', 'string'),
              ('phone_number', 'bigint'), ('gender', 'string'), ('date_of_birth', 'string'),
              ('street_name', 'string'), ('locality', 'string'), ('city', 'string'), ('state', 'string'),
              ('country', 'string'), ('postal_code', 'int'), ('address', 'string')) AS t(column_name, data_type)""",
        "schema_evolution_add_columns": f"""
            SELECT * REPLACE (CASE WHEN order_id % 2 = 1 THEN sales_channel END AS sales_channel)
            FROM (SELECT {_ORDER_COLUMNS} FROM orders_feed)""",
        "append_flow_fan_in": f"""
            SELECT {_ORDER_COLUMNS} FROM orders_feed WHERE order_id % 2 = 0
            UNION ALL SELECT {_ORDER_COLUMNS} FROM orders_feed WHERE order_id % 2 = 1""",
        "bronze_orders": f"SELECT {_ORDER_COLUMNS} FROM orders_bronze",
        "bronze_customers": f"SELECT {_CUSTOMER_COLUMNS} FROM customers_bronze",
        "schema_drift_widening": """
            SELECT order_id, CASE WHEN order_id % 2 = 1 AND order_id % 7 = 0 THEN NULL ELSE quantity END AS quantity,
                   CASE WHEN order_id % 2 = 0 THEN floor(abs(amount)) ELSE amount END AS amount FROM orders_feed""",
        "rescued_values": """
            SELECT order_id, CASE WHEN order_id % 2 = 1 AND order_id % 7 = 0 THEN 'n/a' END AS rescued_quantity
            FROM orders_feed""",
        "schema_order_free": """
            SELECT run, order_id, CASE WHEN order_id % 3 = 2 AND order_id % 7 = 0 THEN NULL ELSE quantity END AS quantity,
                   CASE WHEN order_id % 3 = 0 THEN floor(abs(amount)) ELSE amount END AS amount, payment_method
            FROM orders_feed, (VALUES (0), (1), (2)) AS runs(run)""",
        "stream_type_widening": """
            SELECT order_id, CASE WHEN order_id % 2 = 0 THEN floor(abs(amount)) ELSE amount END AS amount,
                   CASE WHEN order_id % 2 = 1 THEN payment_method END AS payment_method FROM orders_feed""",
        "late_file_ingest": f"SELECT {_ORDER_COLUMNS} FROM orders_feed",
        "odd_file_names": f"SELECT {_ORDER_COLUMNS} FROM orders_feed",
        "dedup_stream_copies": f"SELECT {_ORDER_COLUMNS} FROM orders_feed",
        "scd2_change_feed": f"SELECT {_HISTORY} FROM product_history",
        "scd2_history_heavy": f"SELECT {_HISTORY} FROM product_history",
        "temporal_join_sweep": _TEMPORAL.format(on=f"({_IN_RANGE}) OR ({_EARLY})"),
        "temporal_join_crowded": _TEMPORAL.format(on=f"({_IN_RANGE}) OR ({_EARLY})"),
        "stream_static_join_hot_key": """
            SELECT o.order_id, o.customer_id, c.customer_name, c.city, o.amount
            FROM hot_customers o JOIN customers_clean c ON o.customer_id = c.customer_id""",
        "customer_behavior_hot_key": _behavior("hot_customers_closed"),
        "product_performance_hot_key": _performance("hot_products_closed"),
        "enrich_changing_dimension": """
            SELECT o.order_id, o.customer_id, o.amount, CASE WHEN o.order_id % 2 = 0 THEN c.city ELSE 'new ' || c.city END AS city
            FROM orders_clean o JOIN customers_clean c ON o.customer_id = c.customer_id""",
        "customer_behavior_rewrites": _behavior("appended_closed"),
        "product_performance_incremental": _performance("closed"),
        "bronze_orders_bad_text": f"SELECT {_ORDER_COLUMNS} FROM orders_bronze WHERE order_id % 5 <> 0",
        "bronze_products": f"SELECT {_PRODUCT_COLUMNS} FROM products_bronze",
        "expect_drop_orders": f"SELECT {_ORDER_COLUMNS} FROM orders_bronze",
        "expect_drop_customers": f"SELECT {_CUSTOMER_COLUMNS} FROM customers_bronze",
        "expect_drop_products": f"SELECT {_PRODUCT_COLUMNS} FROM products_bronze",
        "expectation_report": """
            SELECT 'quantity' AS rule, count(*) FILTER (WHERE coalesce(quantity > 0, false)) AS passed,
                   count(*) FILTER (WHERE NOT coalesce(quantity > 0, false)) AS failed FROM orders_feed
            UNION ALL
            SELECT 'amount', count(*) FILTER (WHERE coalesce(amount > 0, false)),
                   count(*) FILTER (WHERE NOT coalesce(amount > 0, false)) FROM orders_feed
            UNION ALL
            SELECT 'order_date', count(order_date), count(*) - count(order_date) FROM orders_feed""",
        "change_feed": f"""
            SELECT {_ORDER_COLUMNS},
                   CASE WHEN order_id % 997 = 0 THEN 'update_postimage' ELSE 'insert' END AS _change_type,
                   order_id // 100 AS _commit_version, ts AS _commit_timestamp FROM orders_feed""",
        "append_only_commits": f"""
            SELECT {_ORDER_COLUMNS}, 'insert' AS _change_type, order_id // 100 AS _commit_version,
                   ts AS _commit_timestamp
            FROM orders_feed o WHERE NOT EXISTS (
                SELECT 1 FROM orders_feed u WHERE u.order_id % 997 = 0 AND u.order_id // 100 = o.order_id // 100)""",
        "append_only_rows": f"""
            SELECT {_ORDER_COLUMNS}, 'insert' AS _change_type, order_id // 100 AS _commit_version,
                   ts AS _commit_timestamp FROM orders_feed WHERE order_id % 997 <> 0""",
        "dedup_full_row": f"SELECT DISTINCT {_ORDER_COLUMNS} FROM orders_feed",
        "dedup_within_commit": f"""
            SELECT {_ORDER_COLUMNS}, 'insert' AS _change_type, v AS _commit_version, ts AS _commit_timestamp
            FROM orders_feed, (VALUES (1), (2)) AS t(v)""",
        "parse_dates_multi_format": """
            SELECT customer_id, date_of_birth AS raw,
                   CAST(coalesce(try_strptime(date_of_birth, '%Y-%m-%d'), try_strptime(date_of_birth, '%Y/%m/%d'),
                                 try_strptime(date_of_birth, '%d/%m/%Y')) AS DATE) AS parsed
            FROM customers_feed""",
        "parse_timestamps_multi_format": """
            SELECT order_id, raw,
                   coalesce(try_strptime(raw, '%Y-%m-%d %H:%M:%S'), try_strptime(raw, '%Y/%m/%d %H:%M:%S'),
                            try_strptime(raw, '%d/%m/%Y %H:%M:%S'), try_strptime(raw, '%Y-%m-%d'),
                            try_strptime(raw, '%Y/%m/%d'), try_strptime(raw, '%d/%m/%Y')) AS parsed
            FROM (SELECT order_id,
                         CASE WHEN order_id % 4 = 3 THEN left(order_date, 10) ELSE order_date END AS raw
                  FROM orders_feed)""",
        "clean_customers": f"SELECT {_CLEAN_CUSTOMER} FROM customers_clean",
        "clean_orders": f"SELECT {_CLEAN_ORDER} FROM orders_clean",
        "clean_products": f"SELECT DISTINCT {_PRODUCT_COLUMNS} FROM products_clean",
        "scd1_customers": _scd1("customer_updates", "customer_id", _UPDATE_COLUMNS, "as_of", "version"),
        "scd1_orders": _scd1("order_updates", "order_id", _ORDER_COLUMNS, "ts", "version"),
        "scd_out_of_order": _scd1("order_updates", "order_id", _ORDER_COLUMNS, "ts", "version"),
        "scd1_with_deletes": _scd1("order_updates", "order_id", _ORDER_COLUMNS, "ts", "version",
                                   "AND payment_method <> 'error'"),
        "scd2_history": f"SELECT {_HISTORY} FROM product_history",
        "scd2_current": f"SELECT {_HISTORY} FROM product_history WHERE end_at IS NULL",
        "scd2_first_start": f"""
            SELECT {_HISTORY}, min(start_at) OVER (PARTITION BY product_id) AS min_start FROM product_history""",
        "price_change_direction": f"""
            SELECT product_id, price, start_at AS "__START_AT", prev_price, {_PRICE_DIRECTION} AS price_direction
            FROM price_steps""",
        "demand_change_direction": f"""
            SELECT payment_method, day, current_demand, prev_demand,
                   {_DIRECTION.format(a="current_demand", b="prev_demand")} AS demand_direction
            FROM (SELECT *, coalesce(lag(current_demand) OVER (PARTITION BY payment_method ORDER BY day),
                                     current_demand) AS prev_demand
                  FROM (SELECT payment_method, date_trunc('day', order_time)::TIMESTAMP AS day,
                               CAST(sum(quantity) AS BIGINT) AS current_demand
                        FROM orders_timed GROUP BY ALL))""",
        "stream_static_join_customer": """
            SELECT o.order_id, o.customer_id, c.customer_name, c.city, c.state, c.gender, o.amount
            FROM orders_clean o JOIN customers_clean c ON o.customer_id = c.customer_id""",
        "stream_static_join_product": """
            SELECT o.order_id, o.product_id, p.product_name, p.category, p.price, o.quantity
            FROM orders_clean o JOIN product_history p ON o.product_id = p.product_id AND p.end_at IS NULL""",
        "temporal_join_strict": _TEMPORAL.format(on=_IN_RANGE),
        "temporal_join_fallback": _TEMPORAL.format(on=f"({_IN_RANGE}) OR ({_EARLY})"),
        "tumbling_window_agg": """
            SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type, count(*) AS n,
                   CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS total
            FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start FROM events)
            WHERE window_start + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE
            GROUP BY window_start, event_type""",
        "null_event_time": """
            SELECT window_start, window_end, count(*) AS n FROM closed GROUP BY ALL""",
        "customer_segment": f"""
            SELECT customer_id, order_count, total_spent, {_SEGMENT.format(t="total_spent")} AS customer_segment
            FROM (SELECT 'CUST' || o_custkey AS customer_id, o_orderdate, count(*) AS order_count,
                         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 4000.0
                           AS total_spent
                  FROM orders GROUP BY ALL)""",
        "customer_behavior": _behavior("closed"),
        "product_performance": _performance("closed"),
        "customer_behavior_batch": _behavior("orders_timed"),
        "product_performance_batch": _performance("orders_timed"),
        "customer_behavior_end_to_end": _behavior("closed"),
        "payment_analysis": f"""
            SELECT payment_method, CAST(sum(cents) AS DOUBLE) / 100.0 AS total_revenue, count(order_id) AS total_orders,
                   {_AVG} AS avg_transaction_value, max(amount) AS max_transaction, min(amount) AS min_transaction
            FROM (SELECT *, CAST(round(amount * 100) AS BIGINT) AS cents FROM orders_clean)
            GROUP BY payment_method""",
        "payment_analysis_fractions": """
            SELECT payment_method, CAST(sum(cents) AS DOUBLE) / 100000.0 AS total_revenue, count(order_id) AS total_orders,
                   ((2 * sum(cents) + 1000 * count(*)) // (2000 * count(*))) / 100.0 AS avg_transaction_value
            FROM (SELECT *, CAST(round(amount * 100) AS BIGINT) AS cents FROM orders_clean)
            GROUP BY payment_method""",
        "price_demand_analysis": _demand(
            f"SELECT {_PERIOD} FROM sales o JOIN price_steps p ON o.product_id = p.product_id "
            f"AND (({_IN_RANGE}) OR ({_EARLY}))"),
        "price_demand_any_product_fallback": _demand(
            f"SELECT {_PERIOD} FROM sales o JOIN price_steps p ON o.product_id = p.product_id AND {_IN_RANGE} "
            f"UNION ALL SELECT {_PERIOD} FROM sales o "
            f"JOIN (SELECT * FROM price_steps WHERE start_at = min_start) p ON o.order_time < p.min_start"),
    }
    plain["price_demand_any_product_fallback_heavy"] = plain["price_demand_any_product_fallback"]
    plain["late_data_drop"] = plain["tumbling_window_agg"]
    return {key: _with(sql) for key, sql in plain.items()}
