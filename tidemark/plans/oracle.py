"""The registered queries in plain SQL, over views named like the files."""

from __future__ import annotations

DAY_MS = 86_400_000
AS_OF_MS = 1_705_000_000_000

# Named sub-queries, each with the ones it builds on.
_STATUS = "CASE o_orderstatus WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'PAID' ELSE 'DELIVERED' END"

_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "src_customers": (
        (),
        "SELECT c_custkey AS customer_id, c_name AS full_name,"
        " concat('user', CAST(c_custkey AS VARCHAR), '@example.com') AS email,"
        " n_name AS country, c_acctbal, c_mktsegment"
        " FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    ),
    "src_products": (
        (),
        "SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,"
        " p_retailprice AS price, p_size AS stock_quantity FROM part",
    ),
    "src_orders": (
        (),
        f"SELECT o_orderkey AS order_id, o_custkey AS customer_id, {_STATUS} AS order_status,"
        " epoch_us(o_orderdate) AS order_date FROM orders",
    ),
    "src_order_items": (
        (),
        "SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,"
        " l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,"
        " l_extendedprice AS unit_price FROM lineitem",
    ),
    "src_payments": (
        (),
        "SELECT o_orderkey * 2 + attempt AS payment_id, o_orderkey AS order_id,"
        " CASE WHEN o_orderstatus <> 'O' THEN 'SUCCESS' ELSE 'INITIATED' END AS payment_status,"
        " CASE WHEN attempt = 1 THEN 'wallet' WHEN o_orderpriority = '1-URGENT' THEN 'credit_card'"
        " WHEN o_orderpriority = '2-HIGH' THEN 'debit_card'"
        " WHEN o_orderpriority = '3-MEDIUM' THEN 'paypal' ELSE 'wallet' END AS payment_method,"
        " o_totalprice AS amount,"
        " CASE WHEN o_orderstatus <> 'O' THEN epoch_us(o_orderdate) END AS paid_at,"
        " epoch_us(o_orderdate) AS updated_at"
        " FROM orders, (VALUES (0), (1)) AS a(attempt)"
        " WHERE attempt = 0 OR o_orderpriority = '1-URGENT'",
    ),
    "order_totals": (
        ("src_order_items",),
        "SELECT order_id, CAST(SUM(quantity * CAST(unit_price AS DECIMAL(28,6))) AS DOUBLE) AS order_revenue,"
        " CAST(SUM(quantity) AS BIGINT) AS total_items FROM src_order_items GROUP BY order_id",
    ),
    "chg_users": (
        (),
        "SELECT user_id, event_id, epoch_us(ts) // 1000 AS ts_ms,"
        " CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op,"
        " event_type, value, props FROM events",
    ),
    "latest_users": (
        ("chg_users",),
        "SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id"
        " ORDER BY ts_ms DESC NULLS FIRST, event_id DESC) AS rn FROM chg_users) WHERE rn = 1",
    ),
    "chg_customers": (
        ("src_customers",),
        "SELECT customer_id, full_name, email,"
        " CASE WHEN seq = 1 AND c_mktsegment = 'BUILDING' THEN 'MOVED' ELSE country END AS country,"
        " CASE WHEN seq = 1 AND c_mktsegment = 'BUILDING' THEN 'u'"
        " WHEN seq = 1 AND c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN 'd'"
        f" ELSE 'r' END AS op, CAST(seq * {DAY_MS} AS BIGINT) AS ts_ms, seq"
        " FROM src_customers, (VALUES (0), (1)) AS s(seq)",
    ),
    "cur_customers": (
        ("chg_customers",),
        "SELECT * FROM chg_customers WHERE seq = 1 AND op <> 'd'",
    ),
    "chg_orders": (
        ("src_orders",),
        "SELECT order_id, customer_id, step AS order_status, order_date,"
        f" order_date // 1000 + seq * {DAY_MS} AS ts_ms, seq FROM src_orders,"
        " (VALUES (0, 'PENDING'), (1, 'PAID'), (2, 'SHIPPED'), (3, 'DELIVERED')) AS s(seq, step)"
        " WHERE seq <= CASE order_status WHEN 'PENDING' THEN 0 WHEN 'PAID' THEN 1 ELSE 3 END",
    ),
    "chg_payments": (
        ("src_payments",),
        f"SELECT payment_id, order_id, updated_at // 1000 + seq * {DAY_MS} AS ts_ms, seq"
        " FROM src_payments, (VALUES (0), (1)) AS s(seq) WHERE seq = 0 OR paid_at IS NOT NULL",
    ),
    "chg_items": (
        (),
        "SELECT l_orderkey * 10 + l_linenumber AS order_item_id,"
        " epoch_us(l_shipdate) // 1000 AS ts_ms FROM lineitem",
    ),
    "chg_status": (
        (),
        f"SELECT o_custkey AS customer_id, o_orderkey AS seq, epoch_us(o_orderdate) // 1000 AS ts_ms,"
        f" {_STATUS} AS order_status FROM orders",
    ),
    "readable": (
        ("chg_users",),
        "SELECT * FROM chg_users WHERE NOT (event_type = 'click' AND value > 100)",
    ),
    "gaps": (
        ("src_customers",),
        "SELECT customer_id, CASE WHEN c_acctbal >= 0 THEN full_name END AS full_name,"
        " CASE WHEN c_acctbal < 9000 THEN email END AS email, country FROM src_customers",
    ),
    "coded": (
        ("src_products",),
        "SELECT product_id, repeat(product_name, stock_quantity) AS product_name,"
        " CASE category WHEN 'ECONOMY' THEN 'Electronics' WHEN 'LARGE' THEN 'Home & Kitchen'"
        " WHEN 'PROMO' THEN 'Clothing' WHEN 'SMALL' THEN 'Books' WHEN 'STANDARD' THEN 'Sports'"
        " ELSE 'Garden' END AS category, price, stock_quantity FROM src_products",
    ),
    "scaled": (
        (),
        "SELECT o_orderkey AS payment_id, o_totalprice * 1000 AS amount FROM orders",
    ),
    "bad_amounts": (
        ("scaled",),
        "SELECT payment_id FROM scaled WHERE TRY_CAST(amount AS DECIMAL(10,2)) IS NULL"
        " OR CAST(TRY_CAST(amount AS DECIMAL(10,2)) AS DOUBLE) <> amount",
    ),
    "bad_products": (
        ("src_order_items", "src_products"),
        "SELECT order_item_id, product_id FROM src_order_items WHERE product_id NOT IN"
        " (SELECT product_id FROM src_products WHERE stock_quantity > 5)",
    ),
    "repeated_items": (
        ("src_order_items",),
        "SELECT order_item_id, COUNT(*) AS n FROM src_order_items GROUP BY 1 HAVING COUNT(*) > 1",
    ),
}


def _with(body: str, *ctes: str) -> str:
    """``body`` under a WITH clause of the named sub-queries and all they build on."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _CTES[name][0]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in ctes:
        add(name)
    clauses = ", ".join(f"{n} AS ({_CTES[n][1]})" for n in order)
    return f"WITH {clauses} {body}"


_FACT = (
    "SELECT order_id, customer_id, order_status, order_date, order_revenue, total_items,"
    " payment_status, payment_method"
    " FROM src_orders LEFT JOIN order_totals USING (order_id)"
)
_USER_STATE = "SELECT user_id, event_id, ts_ms, op, event_type, value, props FROM latest_users"
_CURRENT_USERS = _with(f"{_USER_STATE} WHERE op IS DISTINCT FROM 'd'", "latest_users")
_DIM = (
    "SELECT customer_id, full_name, email, country, valid_from_ms, valid_to_ms,"
    " is_current FROM (SELECT *, ts_ms AS valid_from_ms, LEAD(ts_ms) OVER w AS valid_to_ms,"
    " LEAD(1) OVER w IS NULL AS is_current FROM cur_customers"
    " WINDOW w AS (PARTITION BY customer_id ORDER BY ts_ms))"
)
_BRONZE = _with(
    "SELECT user_id, event_type, value, props, op, ts_ms, 'users' AS source_table,"
    ' event_id * 2 AS "offset" FROM readable',
    "readable",
)


def _fk(name: str, child: str, key: str, col: str, parent: str, parent_key: str, kept: str) -> str:
    return (
        f"SELECT '{name}' AS \"check\", {key} AS id, {col} AS reference FROM {child} c"
        f" WHERE {col} IS NOT NULL AND NOT EXISTS"
        f" (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{col} AND {kept})"
    )


def _rule(table: str, check: str, source: str, failed: str) -> str:
    return (
        f"SELECT '{table}.{check}' AS \"check\", COUNT(*) AS rows_checked,"
        f" COUNT(*) FILTER (WHERE {failed}) AS rows_failed FROM {source}"
    )


_BROKEN_CHAIN = (
    "SELECT customer_id, seq, previous, order_status FROM (SELECT *, LAG(order_status) OVER"
    " (PARTITION BY customer_id ORDER BY ts_ms NULLS LAST, seq) AS previous FROM chg_status)"
    " WHERE previous IS NOT NULL AND previous <> order_status AND (previous, order_status)"
    " NOT IN (('PENDING', 'PAID'), ('PAID', 'SHIPPED'), ('SHIPPED', 'DELIVERED'),"
    " ('DELIVERED', 'CANCELLED'))"
)
_WRONG_AMOUNTS = (
    "SELECT payment_id, order_id, amount, expected FROM (SELECT p.payment_id, p.order_id,"
    " round(t.order_revenue, 2) AS expected,"
    " CASE WHEN p.paid_at IS NOT NULL AND t.order_revenue IS NOT NULL"
    " THEN round(t.order_revenue, 2) + CASE WHEN p.payment_id % 7 = 0 THEN 0.25e0 ELSE 0e0 END"
    " ELSE p.amount END AS amount"
    " FROM src_payments p LEFT JOIN order_totals t ON p.order_id = t.order_id)"
    " WHERE amount IS DISTINCT FROM expected"
)
_UNPAID = (
    "SELECT order_id, order_status FROM src_orders o WHERE order_status <> 'PENDING'"
    " AND NOT EXISTS (SELECT 1 FROM src_payments p WHERE p.order_id = o.order_id"
    " AND payment_method <> 'paypal' AND payment_status = 'SUCCESS' AND paid_at IS NOT NULL)"
)

_GATE_RULES = [
    *[
        _rule("customers", f"not_null:{c}", "gaps", f"{c} IS NULL")
        for c in ("customer_id", "full_name", "email")
    ],
    *[
        _rule("customers", f"length:{c}", "gaps", f"length({c}) > {n}")
        for c, n in (("full_name", 150), ("email", 150), ("country", 80))
    ],
    *[
        _rule("products", f"not_null:{c}", "coded", f"{c} IS NULL")
        for c in ("product_id", "product_name", "price", "stock_quantity")
    ],
    _rule("products", "length:product_name", "coded", "length(product_name) > 200"),
    _rule("products", "length:category", "coded", "length(category) > 100"),
    _rule("products", "decimal:price", "coded", "FALSE"),
    _rule("products", "accepted:category", "coded", "category = 'Garden'"),
    *[
        _rule("orders", f"not_null:{c}", "src_orders", f"{c} IS NULL")
        for c in ("order_id", "customer_id", "order_status", "order_date")
    ],
    _rule("orders", "length:order_status", "src_orders", "length(order_status) > 30"),
    _rule(
        "orders", "accepted:order_status", "src_orders",
        "order_status NOT IN ('PENDING', 'PAID', 'SHIPPED', 'DELIVERED', 'CANCELLED')",
    ),
    _rule("payments", "not_null:payment_id", "scaled", "payment_id IS NULL"),
    _rule("payments", "not_null:amount", "scaled", "amount IS NULL"),
    _rule(
        "payments", "decimal:amount", "scaled",
        "payment_id IN (SELECT payment_id FROM bad_amounts)",
    ),
    "SELECT 'order_items.unique:order_item_id' AS \"check\","
    " (SELECT COUNT(*) FROM src_order_items) AS rows_checked,"
    " (SELECT COUNT(*) FROM repeated_items) AS rows_failed",
    "SELECT 'order_items.foreign_key:product_id' AS \"check\","
    " (SELECT COUNT(*) FROM src_order_items) AS rows_checked,"
    " (SELECT COUNT(*) FROM bad_products) AS rows_failed",
    *[
        f"SELECT '{check}' AS \"check\", (SELECT COUNT(*) FROM {source}) AS rows_checked,"
        f" (SELECT COUNT(*) FROM ({bad})) AS rows_failed"
        for check, source, bad in (
            ("orders.status_chain", "chg_status", _BROKEN_CHAIN),
            ("payments.amount_is_item_total", "src_payments", _WRONG_AMOUNTS),
            ("orders.paid_has_payment", "src_orders", _UNPAID),
        )
    ],
]

# Messages by event number: three partitions, lost and repeated ones.
_TOPIC_LOG = (
    "WITH sent AS (SELECT 'ecom.public.users' AS topic, CAST(event_id % 3 AS INT) AS partition,"
    " event_id // 3 AS \"offset\", event_id FROM events WHERE event_id % 97 <> 0"
    " AND event_id NOT BETWEEN 100 AND 160),"
    " log AS (SELECT * EXCLUDE event_id FROM sent UNION ALL"
    " SELECT * EXCLUDE event_id FROM sent WHERE event_id % 53 = 0)"
)

ORACLE: dict[str, str] = {
    "fct_orders": _with(
        f"{_FACT} LEFT JOIN src_payments USING (order_id)",
        "src_orders", "order_totals", "src_payments",
    ),
    "fct_orders_latest_payment": _with(
        f"{_FACT} LEFT JOIN (SELECT * FROM src_payments QUALIFY ROW_NUMBER() OVER"
        " (PARTITION BY order_id ORDER BY payment_id DESC) = 1) USING (order_id)",
        "src_orders", "order_totals", "src_payments",
    ),
    "dim_customers": _with(_DIM, "cur_customers"),
    "customer_history": _with(
        "SELECT customer_id, full_name, email, country, ts_ms AS valid_from_ms, valid_to_ms,"
        " is_current FROM (SELECT *, LEAD(ts_ms) OVER later AS valid_to_ms,"
        " LEAD(1) OVER later IS NULL AS is_current FROM"
        " (SELECT *, LAG(country) OVER w AS before, ROW_NUMBER() OVER w AS n FROM chg_customers"
        " WINDOW w AS (PARTITION BY customer_id ORDER BY ts_ms, seq))"
        " WHERE n = 1 OR op = 'd' OR country IS DISTINCT FROM before"
        " WINDOW later AS (PARTITION BY customer_id ORDER BY ts_ms, seq)) WHERE op <> 'd'",
        "chg_customers",
    ),
    "preview_dim": _with(f"{_DIM} ORDER BY customer_id LIMIT 5", "cur_customers"),
    "sample_products": _with(
        "SELECT product_id, price FROM src_products"
        " ORDER BY md5(concat(CAST(product_id AS VARCHAR), ':1')), product_id LIMIT 4",
        "src_products",
    ),
    "typed_payments": _with(
        "SELECT payment_id, CAST(CAST(amount AS DECIMAL(10,2)) AS VARCHAR) AS amount,"
        " strftime(make_timestamp(paid_at), '%Y-%m-%d %H:%M:%S') AS paid_at FROM src_payments",
        "src_payments",
    ),
    "current_users": _CURRENT_USERS,
    "current_with_duplicates": _CURRENT_USERS,
    "merge_increment": _CURRENT_USERS,
    "current_all": _with(
        "SELECT 'customers' AS source_table, customer_id AS key, ts_ms FROM cur_customers"
        " UNION ALL SELECT 'products', product_id, CAST(0 AS BIGINT) FROM src_products"
        " UNION ALL SELECT 'orders', order_id, MAX(ts_ms) FROM chg_orders GROUP BY order_id"
        " UNION ALL SELECT 'order_items', order_item_id, MAX(ts_ms) FROM chg_items"
        " GROUP BY order_item_id"
        " UNION ALL SELECT 'payments', payment_id, MAX(ts_ms) FROM chg_payments"
        " GROUP BY payment_id",
        "cur_customers", "src_products", "chg_orders", "chg_items", "chg_payments",
    ),
    "deleted_users": _with("SELECT user_id FROM latest_users WHERE op = 'd'", "latest_users"),
    "state_as_of": _with(
        "SELECT user_id, event_id, ts_ms, op, event_type, value, props FROM"
        " (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC)"
        f" AS rn FROM chg_users WHERE ts_ms <= {AS_OF_MS})"
        " WHERE rn = 1 AND op IS DISTINCT FROM 'd'",
        "chg_users",
    ),
    "silver_audit": _with(
        "SELECT (SELECT COUNT(*) FROM chg_users) AS events_in,"
        " COUNT(*) FILTER (WHERE op IS DISTINCT FROM 'd') AS current_rows,"
        " COUNT(*) FILTER (WHERE op = 'd') AS deleted_keys FROM latest_users",
        "latest_users",
    ),
    "bronze_events": _BRONZE,
    "bronze_reparsed": _BRONZE,
    "bronze_quarantine": (
        "SELECT 'users' AS source_table, event_id * 2 AS \"offset\","
        " 'value does not fit the row schema' AS reason FROM events"
        " WHERE event_type = 'click' AND value > 100"
    ),
    "bronze_counts": _with(
        "SELECT 'users' AS source_table, op, COUNT(*) AS events FROM readable GROUP BY op"
        " UNION ALL SELECT 'customers', op, COUNT(*) FROM chg_customers GROUP BY op"
        " UNION ALL SELECT 'products', 'r', COUNT(*) FROM src_products HAVING COUNT(*) > 0",
        "readable", "chg_customers", "src_products",
    ),
    "observed_columns": _with(
        "SELECT 'users' AS source_table, column_name, COUNT(*) AS events FROM readable,"
        " (VALUES ('user_id'), ('event_type'), ('value'), ('props')) AS c(column_name)"
        " GROUP BY column_name",
        "readable",
    ),
    "schema_evolution": _with(
        "SELECT user_id, event_id, event_type,"
        f" CASE WHEN ts_ms > {AS_OF_MS} THEN value END AS value FROM chg_users",
        "chg_users",
    ),
    "schema_type_drift": _with(
        "SELECT user_id, event_id, CASE WHEN old THEN value ELSE floor(value) END AS value,"
        f" CASE WHEN old THEN ts_ms - ts_ms % {DAY_MS} ELSE ts_ms END AS at,"
        " CASE WHEN old THEN CAST(event_id AS VARCHAR) ELSE event_type END AS code,"
        " CASE WHEN old THEN event_id END AS code_as_bigint,"
        " CASE WHEN NOT old THEN event_type END AS code_as_string"
        f" FROM (SELECT *, ts_ms <= {AS_OF_MS} AS old FROM chg_users)",
        "chg_users",
    ),
    "snapshot_diff_stored": _with(
        "SELECT CASE customer_id % 997 WHEN 1 THEN 'u' WHEN 2 THEN 'c' ELSE 'd' END AS op,"
        " customer_id, CASE WHEN customer_id % 997 <> 2 THEN country END AS old_country,"
        " CASE customer_id % 997 WHEN 1 THEN 'MOVED' WHEN 2 THEN country END AS new_country"
        " FROM src_customers WHERE customer_id % 997 IN (1, 2, 3)",
        "src_customers",
    ),
    "state_as_of_kept": _with(
        " UNION ALL ".join(
            f"SELECT CAST({at} AS BIGINT) AS as_of, user_id, event_id, ts_ms, op, event_type, value, props"
            " FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC)"
            f" AS rn FROM chg_users WHERE ts_ms <= {at}) WHERE rn = 1 AND op IS DISTINCT FROM 'd'"
            for at in (1704400000000, AS_OF_MS, 1706000000000)
        ),
        "chg_users",
    ),
    "log_missing": (
        f"{_TOPIC_LOG} SELECT topic, partition, before + 1 AS first_missing, \"offset\" - 1 AS last_missing,"
        " \"offset\" - before - 1 AS n FROM (SELECT *, LAG(\"offset\", 1, -1) OVER"
        " (PARTITION BY partition ORDER BY \"offset\") AS before FROM (SELECT DISTINCT * FROM log))"
        " WHERE \"offset\" - before > 1"
    ),
    "log_ranges": (
        f"{_TOPIC_LOG}, once AS (SELECT topic, partition, \"offset\", COUNT(*) AS times FROM log GROUP BY ALL)"
        " SELECT topic, partition, MIN(\"offset\") AS first_offset, MAX(\"offset\") AS last_offset,"
        " CAST(SUM(times) AS BIGINT) AS messages FROM (SELECT *, \"offset\" - ROW_NUMBER() OVER"
        " (PARTITION BY partition ORDER BY \"offset\") AS run FROM once) GROUP BY topic, partition, run"
    ),
    "log_read_again": (
        f"{_TOPIC_LOG} SELECT topic, partition, \"offset\", COUNT(*) AS times FROM log"
        " GROUP BY ALL HAVING COUNT(*) > 1"
    ),
    "snapshot_events": _with(
        f"SELECT 'r' AS op, CAST({AS_OF_MS} AS BIGINT) AS ts_ms, TRUE AS no_before,"
        " customer_id, full_name, email, country FROM src_customers",
        "src_customers",
    ),
    "snapshot_diff": _with(
        "SELECT CASE WHEN o.customer_id IS NULL THEN 'c' WHEN n.customer_id IS NULL THEN 'd'"
        f" ELSE 'u' END AS op, CAST({AS_OF_MS} AS BIGINT) AS ts_ms,"
        " coalesce(n.customer_id, o.customer_id) AS customer_id,"
        " o.country AS old_country, n.country AS new_country FROM"
        " (SELECT * FROM src_customers WHERE c_mktsegment <> 'AUTOMOBILE') o FULL JOIN"
        " (SELECT * REPLACE (CASE WHEN c_mktsegment = 'BUILDING' THEN 'MOVED' ELSE country END"
        " AS country) FROM src_customers WHERE c_mktsegment <> 'MACHINERY') n"
        " ON o.customer_id = n.customer_id"
        " WHERE o.customer_id IS NULL OR n.customer_id IS NULL"
        " OR o.country IS DISTINCT FROM n.country OR o.full_name IS DISTINCT FROM n.full_name"
        " OR o.email IS DISTINCT FROM n.email",
        "src_customers",
    ),
    "scd2_from_current": _with(
        "SELECT user_id, event_type, value, props, valid_from_ms, valid_to_ms,"
        " is_current FROM (SELECT *, ts_ms AS valid_from_ms, LEAD(ts_ms) OVER w AS valid_to_ms,"
        " LEAD(1) OVER w IS NULL AS is_current FROM latest_users WHERE op IS DISTINCT FROM 'd'"
        " WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms))",
        "latest_users",
    ),
    "scd2_history": _with(
        "SELECT user_id, event_type, value, props, ts_ms AS valid_from_ms, valid_to_ms,"
        " is_current FROM (SELECT *, LEAD(ts_ms) OVER w AS valid_to_ms,"
        " LEAD(1) OVER w IS NULL AS is_current FROM chg_users"
        " WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms NULLS LAST, event_id))"
        " WHERE op IS DISTINCT FROM 'd'",
        "chg_users",
    ),
    "scd2_history_compact": _with(
        "SELECT user_id, event_type, ts_ms AS valid_from_ms, valid_to_ms,"
        " is_current FROM (SELECT *, LEAD(ts_ms) OVER later AS valid_to_ms,"
        " LEAD(1) OVER later IS NULL AS is_current FROM"
        " (SELECT *, LAG(op) OVER w AS prev_op, LAG(event_type) OVER w AS prev_type,"
        " ROW_NUMBER() OVER w AS n FROM chg_users"
        " WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms NULLS LAST, event_id))"
        " WHERE n = 1 OR op IS NOT DISTINCT FROM 'd' OR prev_op IS NOT DISTINCT FROM 'd'"
        " OR event_type IS DISTINCT FROM prev_type"
        " WINDOW later AS (PARTITION BY user_id ORDER BY ts_ms NULLS LAST, event_id))"
        " WHERE op IS DISTINCT FROM 'd'",
        "chg_users",
    ),
    "transitions": _with(
        "SELECT previous, op AS next, COUNT(*) AS n FROM (SELECT op, LAG(op) OVER"
        " (PARTITION BY user_id ORDER BY ts_ms NULLS LAST, event_id) AS previous FROM chg_users)"
        " GROUP BY previous, op",
        "chg_users",
    ),
    "event_order": _with(
        "SELECT user_id, event_id, ts_ms, ROW_NUMBER() OVER"
        " (PARTITION BY user_id ORDER BY ts_ms NULLS LAST, event_id) AS event_no FROM chg_users",
        "chg_users",
    ),
    "q_not_null": _with(
        "SELECT customer_id, 'not_null:full_name' AS \"check\" FROM gaps WHERE full_name IS NULL"
        " UNION ALL SELECT customer_id, 'not_null:email' FROM gaps WHERE email IS NULL",
        "gaps",
    ),
    "q_unique": _with("SELECT order_item_id, n FROM repeated_items", "repeated_items"),
    "q_unique_batches": _with("SELECT order_item_id FROM repeated_items", "repeated_items"),
    "q_foreign_key_batches": _with(
        "SELECT order_item_id, product_id FROM src_order_items WHERE product_id NOT IN"
        " (SELECT product_id FROM src_products WHERE stock_quantity > 5)",
        "src_order_items", "src_products",
    ),
    "q_foreign_key": _with(
        " UNION ALL ".join(
            [
                _fk("orders.customer_id", "src_orders", "order_id", "customer_id",
                    "src_customers", "customer_id", "c_acctbal >= 0"),
                _fk("order_items.order_id", "src_order_items", "order_item_id", "order_id",
                    "src_orders", "order_id", "order_status <> 'PAID'"),
                _fk("order_items.product_id", "src_order_items", "order_item_id", "product_id",
                    "src_products", "product_id", "stock_quantity > 5"),
                _fk("payments.order_id", "src_payments", "payment_id", "order_id",
                    "src_orders", "order_id", "order_status <> 'PAID'"),
            ]
        ),
        "src_customers", "src_products", "src_orders", "src_order_items", "src_payments",
    ),
    "q_length": _with(
        "SELECT product_id, 'length:product_name' AS \"check\" FROM coded"
        " WHERE length(product_name) > 200",
        "coded",
    ),
    "q_decimal": _with(
        "SELECT payment_id, 'decimal:amount' AS \"check\" FROM bad_amounts", "bad_amounts"
    ),
    "q_accepted": _with(
        "SELECT product_id, 'accepted:category' AS \"check\" FROM coded"
        " WHERE category = 'Garden'",
        "coded",
    ),
    "q_transition": _with(_BROKEN_CHAIN, "chg_status"),
    "q_reconcile": _with(_WRONG_AMOUNTS, "src_payments", "order_totals"),
    "q_paid": _with(_UNPAID, "src_orders", "src_payments"),
    "q_gate": _with(
        'SELECT "check", rows_checked, rows_failed, rows_failed = 0 AS passed FROM ('
        + " UNION ALL ".join(_GATE_RULES)
        + ")",
        "gaps", "coded", "src_orders", "scaled", "bad_amounts", "repeated_items", "bad_products",
        "chg_status", "src_payments", "order_totals",
    ),
    "bronze_ingest_time": _with("SELECT TRUE AS iso, COUNT(*) AS rows FROM readable", "readable"),
    "silver_replaced": _CURRENT_USERS,
    "silver_published": _with(
        "SELECT customer_id, full_name, email, country FROM src_customers", "src_customers"
    ),
    "silver_skipped": _with(
        "SELECT customer_id, full_name, email, country FROM src_customers", "src_customers"
    ),
    "gold_materialized": _with(_DIM, "cur_customers"),
    "stream_bronze": _BRONZE,
    "bronze_compacted": _BRONZE,
    "ingest_batches": (
        "SELECT TRUE AS batches_as_due, COUNT(*) AS messages,"
        " CAST(COUNT(*) FILTER (WHERE event_type = 'click' AND value > 100) AS BIGINT) AS failed FROM events"
    ),
    "state_store": _with(
        "SELECT COUNT(*) AS keys_kept, COUNT(*) AS keys_in_log, CAST(0 AS BIGINT) AS differ FROM latest_users",
        "latest_users",
    ),
    "stream_merge": _CURRENT_USERS,
    "stream_current": _CURRENT_USERS,
}
