"""The registered queries as plain SQL over the driver's tables.

Written from the definition of each result, not from the Spark plans: distinct
counts, row numbers and row-grain joins stand where the operators use rewrites.
"""

from __future__ import annotations

RUN_TS = "TIMESTAMP '2001-08-01 00:00:00'"
AS_OF = "DATE '2001-08-01'"
INVENTORY_AS_OF = "DATE '2001-11-05'"

_CTE = {
    "lines": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS rn
            FROM lineitem)
        WHERE rn = 1""",
    "r_orders": """
        SELECT concat_ws('-', l_orderkey, l_linenumber) AS order_id,
               CAST(o_custkey AS VARCHAR) AS customer_id,
               CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS total_amount,
               o_orderpriority AS payment_method,
               o_orderstatus AS order_status,
               o_orderdate AS order_timestamp
        FROM {lines}
        JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey""",
    "r_products": f"""
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               p_name AS product_name,
               p_type AS category,
               'S' || CAST(p_size % 3 AS VARCHAR) AS subcategory,
               p_brand AS brand,
               p_retailprice AS price,
               CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 0.6 AS DECIMAL(12,3)) AS cost_price,
               CAST(p_size * 2 AS DOUBLE) AS popularity_score,
               CAST({AS_OF} - CAST(p_partkey % 365 AS INTEGER) AS DATE) AS launch_date,
               p_partkey % 4 <> 0 AS is_active
        FROM part""",
    "r_customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               'Customer' AS first_name,
               c_name AS last_name,
               c_name || '@x.test' AS email,
               CAST(c_nationkey AS VARCHAR) AS city,
               CAST(c_nationkey AS VARCHAR) AS state,
               CAST(DATE '1995-01-01' + CAST(c_custkey % 1095 AS INTEGER) AS DATE) AS signup_date,
               c_mktsegment AS loyalty_tier,
               'P' || CAST(c_custkey % 6 AS VARCHAR) AS preferred_category
        FROM customer""",
    "r_movements": """
        SELECT concat_ws('-', l_orderkey, l_linenumber) AS inventory_event_id,
               CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(l_suppkey % 4 AS VARCHAR) AS warehouse_id,
               CASE WHEN l_returnflag = 'R' THEN 'STOCK_IN'
                    WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'ADJUSTMENT'
                    WHEN l_returnflag = 'A' THEN 'STOCK_OUT'
                    ELSE 'SALE' END AS movement_type,
               CAST(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER)
                    WHEN l_returnflag = 'A' AND l_linestatus = 'F'
                        THEN CAST(l_quantity AS INTEGER) % 21 - 10
                    ELSE -CAST(l_quantity AS INTEGER) END AS INTEGER) AS quantity_change,
               l_shipdate AS event_timestamp
        FROM {lines}""",
    "r_clicks": """
        SELECT CAST(user_id AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
               CAST(user_id AS VARCHAR) AS customer_id,
               CASE WHEN event_type = 'view' THEN 'view_product'
                    WHEN event_type = 'click' THEN 'add_to_cart'
                    WHEN event_type = 'signup' THEN 'checkout'
                    WHEN event_type = 'purchase' AND value >= 80 THEN 'purchase'
                    ELSE 'remove_from_cart' END AS event_type,
               regexp_extract(props, '"k": *([0-9]+)', 1) AS product_id,
               ts AS event_timestamp
        FROM events""",
    "first_load": f"""
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
               p_type AS category, 'S' || CAST(p_size % 3 AS VARCHAR) AS subcategory,
               p_brand AS brand, p_retailprice AS price,
               CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 0.6 AS DOUBLE) AS cost_price,
               CAST(p_size AS DOUBLE) AS popularity_score, DATE '1995-01-01' AS launch_date,
               TRUE AS is_active, 'I' AS operation,
               TIMESTAMP '1995-01-01 00:00:00' AS source_updated_at,
               TIMESTAMP '1995-01-01 00:00:00' AS processed_timestamp
        FROM part""",
    "change_events": f"""
        SELECT CAST(l_partkey AS VARCHAR) AS product_id, trim(p_name) AS product_name,
               p_type AS category, 'S' || CAST(p_size % 3 AS VARCHAR) AS subcategory,
               p_brand AS brand, l_extendedprice AS price,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.6 AS DOUBLE) AS cost_price,
               l_quantity AS popularity_score, DATE '1995-01-01' AS launch_date,
               TRUE AS is_active,
               CASE l_returnflag WHEN 'N' THEN 'U' WHEN 'A' THEN 'I' ELSE 'D' END AS operation,
               l_shipdate AS source_updated_at,
               {RUN_TS} AS processed_timestamp
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "changes": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY source_updated_at DESC,
                product_name, category, subcategory, brand, price, cost_price,
                popularity_score, launch_date, is_active, operation) AS rn
            FROM {change_events})
        WHERE rn = 1""",
    "sale_moves": """
        SELECT 'INV_' || order_id AS inventory_event_id, product_id,
               ['WH_BLR', 'WH_MUM', 'WH_DEL', 'WH_HYD'][
                   1 + ('0x' || substr(md5(order_id), 1, 8))::BIGINT % 4] AS warehouse_id,
               'SALE' AS movement_type, CAST(-abs(quantity) AS INTEGER) AS quantity_change,
               order_timestamp AS event_timestamp
        FROM {r_orders}""",
    "order_clicks": """
        SELECT 'SESS_' || order_id AS session_id, customer_id, event_type, product_id,
               order_timestamp - to_minutes(minutes) AS event_timestamp
        FROM {r_orders}
        CROSS JOIN (VALUES ('view_product', 4), ('add_to_cart', 3), ('checkout', 2),
                           ('purchase', 1)) AS steps(event_type, minutes)""",
}

_HISTORY_COLUMNS = (
    "product_id, product_name, category, subcategory, brand, price, cost_price, "
    "popularity_score, launch_date, is_active"
)


def _ctes(names: tuple[str, ...]) -> str:
    """WITH list holding the named tables and whatever they use, in order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for used in _CTE:
            if "{" + used + "}" in _CTE[name]:
                visit(used)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    bodies = {n: _CTE[n] for n in ordered}
    for used in _CTE:
        bodies = {n: b.replace("{" + used + "}", used) for n, b in bodies.items()}
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in bodies.items())


def _sql(body: str, *names: str) -> str:
    return f"{_ctes(names)}\n{body}" if names else body


def _run_columns(ts: str = RUN_TS) -> str:
    return (
        f"{ts} AS processed_timestamp, CAST(year({ts}) AS INTEGER) AS year,"
        f" CAST(month({ts}) AS INTEGER) AS month, CAST(day({ts}) AS INTEGER) AS day"
    )


def _days(start: str, end: str) -> str:
    return f"CAST(date_diff('day', CAST({start} AS DATE), {end}) AS INTEGER)"


def _history(expire_on_insert: bool = False) -> str:
    """The history after both loads, from the definition of each operation."""
    closing = "('U', 'D', 'I')" if expire_on_insert else "('U', 'D')"
    return f"""
        SELECT {_qualified('f')}, f.source_updated_at AS effective_from,
               CASE WHEN c.product_id IS NOT NULL THEN c.source_updated_at END AS effective_to,
               c.product_id IS NULL AS is_current, f.processed_timestamp
        FROM first_load f
        LEFT JOIN (SELECT * FROM changes WHERE operation IN {closing}) c USING (product_id)
        UNION ALL
        SELECT {_HISTORY_COLUMNS}, source_updated_at, NULL, TRUE, processed_timestamp
        FROM changes WHERE operation IN ('I', 'U')"""


def _qualified(alias: str) -> str:
    return ", ".join(f"{alias}.{c.strip()}" for c in _HISTORY_COLUMNS.split(","))


_MOVEMENT_TOTALS = """
    CAST(sum(CASE WHEN movement_type = 'STOCK_IN' THEN quantity_change ELSE 0 END) AS BIGINT) AS stock_in,
    CAST(sum(CASE WHEN movement_type = 'STOCK_OUT' THEN -quantity_change ELSE 0 END) AS BIGINT) AS stock_out,
    CAST(sum(CASE WHEN movement_type = 'SALE' THEN -quantity_change ELSE 0 END) AS BIGINT) AS sales_inventory,
    CAST(sum(CASE WHEN movement_type = 'ADJUSTMENT' THEN quantity_change ELSE 0 END) AS BIGINT) AS adjustments,
    CAST(sum(quantity_change) AS BIGINT) AS net_inventory_change"""

_FUNNEL = f"""
    SELECT product_id, product_views, cart_additions, checkout_starts, purchases,
           unique_customers, unique_sessions,
           CASE WHEN product_views = 0 THEN 0.0::DOUBLE
                ELSE cart_additions::DOUBLE / product_views * 100 END AS view_to_cart_rate,
           CASE WHEN cart_additions = 0 THEN 0.0::DOUBLE
                ELSE checkout_starts::DOUBLE / cart_additions * 100 END AS cart_to_checkout_rate,
           CASE WHEN checkout_starts = 0 THEN 0.0::DOUBLE
                ELSE purchases::DOUBLE / checkout_starts * 100 END AS checkout_to_purchase_rate,
           CASE WHEN product_views = 0 THEN 0.0::DOUBLE
                ELSE purchases::DOUBLE / product_views * 100 END AS overall_conversion_rate,
           cart_additions - checkout_starts AS cart_abandonments,
           checkout_starts - purchases AS checkout_abandonments,
           CASE WHEN product_views = 0 THEN 'Needs Attention'
                WHEN purchases::DOUBLE / product_views * 100 >= 15 THEN 'Excellent'
                WHEN purchases::DOUBLE / product_views * 100 >= 8 THEN 'Good'
                ELSE 'Needs Attention' END AS funnel_status,
           {_run_columns()}
    FROM (
        SELECT product_id,
               count(*) FILTER (event_type = 'view_product') AS product_views,
               count(*) FILTER (event_type = 'add_to_cart') AS cart_additions,
               count(*) FILTER (event_type = 'checkout') AS checkout_starts,
               count(*) FILTER (event_type = 'purchase') AS purchases,
               count(DISTINCT customer_id) AS unique_customers,
               count(DISTINCT session_id) AS unique_sessions
        FROM r_clicks GROUP BY product_id)"""

_ORDER_COLUMNS = (
    "order_id, customer_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, "
    "CAST(total_amount AS DOUBLE) AS total_amount, payment_method, order_status, order_timestamp"
)
_LANDED = (
    "CAST(year({0}) AS INTEGER) AS year, CAST(month({0}) AS INTEGER) AS month,"
    " CAST(day(date_trunc('month', {0})) AS INTEGER) AS day"
)
_SILVER_ORDERS = (
    f"SELECT {_ORDER_COLUMNS}, {_LANDED.format('order_timestamp')},"
    f" {RUN_TS} AS processed_timestamp FROM r_orders"
)
_CATEGORY_REVENUE = (
    "SELECT category, CAST(sum(total_amount) AS DOUBLE) AS revenue"
    " FROM r_orders JOIN r_products USING (product_id) GROUP BY category"
)

ORACLE: dict[str, str] = {
    "revenue_by_category": _sql(_CATEGORY_REVENUE, "r_orders", "r_products"),
    "revenue_by_category_sql": _sql(_CATEGORY_REVENUE, "r_orders", "r_products"),
    "revenue_by_month_category": _sql(
        """
        SELECT CAST(year(order_timestamp) AS INTEGER) AS year,
               strftime(order_timestamp, '%B') AS month_name, category,
               CAST(sum(total_amount) AS DOUBLE) AS revenue
        FROM r_orders JOIN r_products USING (product_id)
        WHERE order_timestamp IS NOT NULL
        GROUP BY ALL""",
        "r_orders",
        "r_products",
    ),
    "fact_orders": _sql(
        f"SELECT {_ORDER_COLUMNS}, {RUN_TS} AS processed_timestamp FROM r_orders", "r_orders"
    ),
    "fact_orders_loaded": _sql(
        f"SELECT {_ORDER_COLUMNS}, {RUN_TS} AS processed_timestamp FROM r_orders", "r_orders"
    ),
    "dim_product": _sql(
        "SELECT DISTINCT product_id, product_name, category, brand, price, launch_date,"
        f" is_active, {RUN_TS} AS processed_timestamp FROM r_products",
        "r_products",
    ),
    "dim_customer": _sql(
        "SELECT DISTINCT customer_id, first_name, last_name, email, city, state, loyalty_tier,"
        f" signup_date, {RUN_TS} AS processed_timestamp FROM r_customers",
        "r_customers",
    ),
    "dim_date": _sql(
        """
        SELECT DISTINCT CAST(order_timestamp AS DATE) AS full_date,
               CAST(year(order_timestamp) AS INTEGER) AS year,
               CAST(month(order_timestamp) AS INTEGER) AS month,
               CAST(day(order_timestamp) AS INTEGER) AS day,
               CAST(quarter(order_timestamp) AS INTEGER) AS quarter,
               strftime(order_timestamp, '%B') AS month_name,
               strftime(order_timestamp, '%A') AS weekday_name
        FROM r_orders""",
        "r_orders",
    ),
    "preview_orders": _sql(
        f"SELECT {_ORDER_COLUMNS}, {RUN_TS} AS processed_timestamp"
        " FROM r_orders ORDER BY order_id LIMIT 10",
        "r_orders",
    ),
    "sessions_basic": _sql(
        """
        SELECT session_id, customer_id, count(*) AS total_events,
               min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
               CAST(max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS INTEGER) AS purchased,
               CAST(floor(epoch(max(event_timestamp))) AS BIGINT)
                   - CAST(floor(epoch(min(event_timestamp))) AS BIGINT) AS session_duration_seconds
        FROM r_clicks GROUP BY session_id, customer_id""",
        "r_clicks",
    ),
    "customer_metrics_basic": _sql(
        """
        SELECT customer_id, count(order_id) AS total_orders,
               CAST(sum(total_amount) AS DOUBLE) AS total_spent,
               CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value,
               CAST(sum(quantity) AS BIGINT) AS total_quantity_purchased
        FROM r_orders GROUP BY customer_id""",
        "r_orders",
    ),
    "daily_sales_basic": _sql(
        """
        SELECT CAST(order_timestamp AS DATE) AS order_date, count(order_id) AS total_orders,
               CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
               CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value,
               count(DISTINCT customer_id) AS unique_customers
        FROM r_orders GROUP BY 1""",
        "r_orders",
    ),
    "inventory_health_basic": _sql(
        """
        SELECT product_id, warehouse_id, count(inventory_event_id) AS total_movements,
               CAST(sum(quantity_change) AS BIGINT) AS net_inventory_change,
               CAST(sum(greatest(quantity_change, 0)) AS BIGINT) AS total_stock_in,
               CAST(sum(greatest(-quantity_change, 0)) AS BIGINT) AS total_stock_out
        FROM r_movements GROUP BY product_id, warehouse_id""",
        "r_movements",
    ),
    "top_products_basic": _sql(
        """
        SELECT product_id, count(order_id) AS total_orders,
               CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
               CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
               CAST(sum(unit_price) AS DOUBLE) / count(unit_price) AS avg_selling_price
        FROM r_orders GROUP BY product_id""",
        "r_orders",
    ),
    "gold_daily_sales": _sql(
        f"""
        , grouped AS (
            SELECT CAST(order_timestamp AS DATE) AS sale_date, category, brand,
                   count(*) AS total_orders, CAST(sum(quantity) AS BIGINT) AS units_sold,
                   CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
                   count(DISTINCT customer_id) AS unique_customers,
                   count(DISTINCT product_id) AS unique_products,
                   CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS average_order_value,
                   CAST(sum(quantity) AS DOUBLE) / count(quantity) AS average_order_quantity,
                   CAST(sum(quantity * cost_price) AS DOUBLE) AS estimated_cost,
                   count(DISTINCT CASE WHEN is_active THEN product_id END) AS active_products_sold,
                   CAST(sum(CASE WHEN {_days('launch_date', AS_OF)} <= 90 THEN total_amount
                                 ELSE 0 END) AS DOUBLE) AS new_product_revenue
            FROM r_orders LEFT JOIN r_products USING (product_id)
            GROUP BY 1, 2, 3),
        lagged AS (
            SELECT *, total_revenue - estimated_cost AS gross_profit,
                   lag(total_revenue) OVER (PARTITION BY category, brand ORDER BY sale_date)
                       AS previous_day_revenue
            FROM grouped),
        grown AS (
            SELECT *, CASE WHEN previous_day_revenue IS NULL OR previous_day_revenue = 0 THEN NULL
                      ELSE (total_revenue - previous_day_revenue) / previous_day_revenue * 100
                      END AS daily_growth_percent
            FROM lagged)
        SELECT sale_date, category, brand, total_orders, units_sold, total_revenue,
               unique_customers, unique_products, average_order_value, average_order_quantity,
               estimated_cost, gross_profit,
               CASE WHEN total_revenue = 0 THEN 0.0::DOUBLE
                    ELSE gross_profit / total_revenue * 100 END AS gross_margin_percent,
               active_products_sold, new_product_revenue, previous_day_revenue,
               daily_growth_percent,
               CASE WHEN daily_growth_percent IS NULL THEN 'New'
                    WHEN daily_growth_percent >= 20 THEN 'High Growth'
                    WHEN daily_growth_percent >= 0 THEN 'Stable'
                    ELSE 'Declining' END AS sales_trend,
               {_run_columns()}
        FROM grown""",
        "r_orders",
        "r_products",
    ),
    "gold_inventory_health": _sql(
        f"""
        , grouped AS (
            SELECT product_id, warehouse_id, count(*) AS total_inventory_events,
                   {_MOVEMENT_TOTALS}, max(event_timestamp) AS last_inventory_event
            FROM r_movements GROUP BY product_id, warehouse_id),
        rated AS (
            SELECT *, stock_out + sales_inventory AS total_outbound,
                   CASE WHEN stock_in = 0 THEN NULL
                        ELSE (stock_out + sales_inventory)::DOUBLE / stock_in END
                       AS inventory_consumption_ratio
            FROM grouped)
        SELECT product_id, product_name, category, subcategory, brand, is_active, warehouse_id,
               stock_in, stock_out, sales_inventory, adjustments, total_outbound,
               net_inventory_change, total_inventory_events, last_inventory_event,
               {_days('last_inventory_event', INVENTORY_AS_OF)} AS days_since_last_inventory_event,
               inventory_consumption_ratio,
               CASE WHEN inventory_consumption_ratio IS NULL THEN 'Unknown'
                    WHEN inventory_consumption_ratio >= 1 THEN 'Critical'
                    WHEN inventory_consumption_ratio >= 0.7::DOUBLE THEN 'Watch'
                    ELSE 'Healthy' END AS inventory_status,
               CAST(row_number() OVER (PARTITION BY product_id
                    ORDER BY total_inventory_events DESC, warehouse_id) AS INTEGER)
                   AS warehouse_activity_rank,
               {_run_columns()}
        FROM rated LEFT JOIN r_products USING (product_id)""",
        "r_movements",
        "r_products",
    ),
    "gold_product_performance": _sql(
        f"""
        , sales AS (
            SELECT product_id, count(*) AS total_orders, CAST(sum(quantity) AS BIGINT) AS units_sold,
                   sum(total_amount) AS total_revenue,
                   CAST(sum(quantity) AS DOUBLE) / count(quantity) AS average_order_quantity,
                   count(DISTINCT customer_id) AS unique_customers,
                   min(order_timestamp) AS first_sale_date, max(order_timestamp) AS last_sale_date
            FROM r_orders GROUP BY product_id),
        stock AS (SELECT product_id, {_MOVEMENT_TOTALS} FROM r_movements GROUP BY product_id),
        filled AS (
            SELECT p.*, coalesce(total_orders, 0) AS total_orders,
                   coalesce(units_sold, 0) AS units_sold,
                   coalesce(total_revenue, 0) AS exact_revenue,
                   CAST(coalesce(total_revenue, 0) AS DOUBLE) AS total_revenue,
                   coalesce(average_order_quantity, 0) AS average_order_quantity,
                   coalesce(unique_customers, 0) AS unique_customers,
                   first_sale_date, last_sale_date,
                   coalesce(stock_in, 0) AS stock_in, coalesce(stock_out, 0) AS stock_out,
                   coalesce(adjustments, 0) AS adjustments,
                   coalesce(sales_inventory, 0) AS sales_inventory,
                   coalesce(net_inventory_change, 0) AS net_inventory_change,
                   coalesce(units_sold, 0) * CAST(cost_price AS DOUBLE) AS estimated_cost
            FROM r_products p LEFT JOIN sales USING (product_id) LEFT JOIN stock USING (product_id)),
        mean AS (SELECT CAST(sum(exact_revenue) AS DOUBLE) / count(*) AS average_product_revenue
                 FROM filled)
        SELECT product_id, product_name, category, subcategory, brand, price,
               CAST(cost_price AS DOUBLE) AS cost_price, launch_date, is_active, popularity_score,
               total_orders, units_sold, total_revenue, average_order_quantity, unique_customers,
               first_sale_date, last_sale_date,
               {_days('last_sale_date', AS_OF)} AS days_since_last_sale,
               stock_in, stock_out, adjustments, sales_inventory, net_inventory_change,
               estimated_cost, total_revenue - estimated_cost AS gross_profit,
               CASE WHEN total_revenue = 0 THEN 0.0::DOUBLE
                    ELSE (total_revenue - estimated_cost) / total_revenue * 100
                    END AS gross_margin_percent,
               average_product_revenue,
               CASE WHEN total_revenue >= average_product_revenue * 1.5::DOUBLE THEN 'Best Seller'
                    WHEN total_revenue >= average_product_revenue THEN 'Good Performer'
                    ELSE 'Slow Moving' END AS product_status,
               CASE WHEN net_inventory_change < -100 THEN 'Low Stock Risk'
                    ELSE 'Healthy' END AS inventory_risk,
               CASE WHEN units_sold > popularity_score * 5 THEN 'Overperforming'
                    WHEN units_sold < popularity_score THEN 'Underperforming'
                    ELSE 'On Track' END AS sales_vs_popularity,
               {_run_columns()}
        FROM filled, mean""",
        "r_orders",
        "r_products",
        "r_movements",
    ),
    "gold_conversion_funnel": _sql(_FUNNEL, "r_clicks"),
    "gold_rerun": _sql(_FUNNEL, "r_clicks"),
    "gold_customer_metrics": _sql(
        f"""
        , bought AS (
            SELECT r_orders.*, category, brand
            FROM r_orders LEFT JOIN r_products USING (product_id)),
        metrics AS (
            SELECT customer_id, count(*) AS total_orders,
                   CAST(sum(quantity) AS BIGINT) AS total_quantity,
                   CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
                   CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS average_order_value,
                   CAST(max(total_amount) AS DOUBLE) AS highest_order_value,
                   CAST(min(total_amount) AS DOUBLE) AS lowest_order_value,
                   CAST(sum(quantity) AS DOUBLE) / count(quantity) AS average_order_quantity,
                   min(order_timestamp) AS first_purchase_date,
                   max(order_timestamp) AS last_purchase_date
            FROM bought GROUP BY customer_id),
        categories AS (
            SELECT customer_id, category AS favorite_category, row_number() OVER (
                PARTITION BY customer_id ORDER BY count(*) DESC, category NULLS FIRST) AS rn
            FROM bought GROUP BY customer_id, category),
        brands AS (
            SELECT customer_id, brand AS favorite_brand, row_number() OVER (
                PARTITION BY customer_id ORDER BY count(*) DESC, brand NULLS FIRST) AS rn
            FROM bought GROUP BY customer_id, brand),
        latest AS (
            SELECT customer_id, category AS most_recent_category, brand AS most_recent_brand,
                   order_timestamp AS most_recent_purchase_timestamp, row_number() OVER (
                PARTITION BY customer_id ORDER BY order_timestamp DESC NULLS LAST,
                    category NULLS FIRST, brand NULLS FIRST) AS rn
            FROM bought)
        SELECT c.customer_id, first_name, last_name, email, city, state, signup_date,
               {_days('signup_date', AS_OF)} AS customer_tenure_days,
               loyalty_tier, preferred_category,
               coalesce(total_orders, 0) AS total_orders,
               coalesce(total_quantity, 0) AS total_quantity,
               coalesce(total_revenue, 0) AS total_revenue,
               coalesce(average_order_value, 0) AS average_order_value,
               coalesce(highest_order_value, 0) AS highest_order_value,
               coalesce(lowest_order_value, 0) AS lowest_order_value,
               coalesce(average_order_quantity, 0) AS average_order_quantity,
               first_purchase_date, last_purchase_date,
               {_days('last_purchase_date', AS_OF)} AS days_since_last_purchase,
               favorite_category, favorite_brand, most_recent_category, most_recent_brand,
               most_recent_purchase_timestamp,
               CASE WHEN last_purchase_date IS NULL THEN 'Never Purchased'
                    WHEN {_days('last_purchase_date', AS_OF)} <= 30 THEN 'Active'
                    WHEN {_days('last_purchase_date', AS_OF)} <= 90 THEN 'At Risk'
                    ELSE 'Inactive' END AS customer_status,
               {_run_columns()}
        FROM r_customers c
        LEFT JOIN metrics m ON c.customer_id = m.customer_id
        LEFT JOIN categories k ON c.customer_id = k.customer_id AND k.rn = 1
        LEFT JOIN brands b ON c.customer_id = b.customer_id AND b.rn = 1
        LEFT JOIN latest l ON c.customer_id = l.customer_id AND l.rn = 1""",
        "r_orders",
        "r_products",
        "r_customers",
    ),
    "dedup_orders": f"""
        SELECT {_ORDER_COLUMNS}, {RUN_TS} AS processed_timestamp FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_timestamp DESC,
                customer_id, product_id, quantity, unit_price, total_amount, payment_method,
                order_status) AS rn
            FROM ({_CTE['r_orders'].replace('{lines}', 'lineitem')}))
        WHERE rn = 1""",
    "clean_product_changes": _sql("SELECT * FROM changes", "changes"),
    "scd2_history": _sql(_history(), "first_load", "changes"),
    "scd2_history_expiring": _sql(_history(expire_on_insert=True), "first_load", "changes"),
    "scd2_published": _sql(_history(), "first_load", "changes"),
    "scd2_current": _sql(
        f"SELECT * FROM ({_history()}) WHERE is_current", "first_load", "changes"
    ),
    "scd2_two_current": _sql(
        f"SELECT product_id, count(*) AS current_versions FROM ({_history()})"
        " WHERE is_current GROUP BY product_id HAVING count(*) > 1",
        "first_load",
        "changes",
    ),
    "enriched_orders": _sql(
        f"SELECT {_ORDER_COLUMNS}, {RUN_TS} AS processed_timestamp, category, brand,"
        " CAST(cost_price AS DOUBLE) AS cost_price, launch_date, is_active"
        " FROM r_orders LEFT JOIN r_products USING (product_id)",
        "r_orders",
        "r_products",
    ),
    "sale_movements": _sql("SELECT * FROM sale_moves", "sale_moves"),
    "funnel_events": _sql("SELECT * FROM order_clicks", "order_clicks"),
    "combined_movements": _sql(
        "SELECT * FROM r_movements UNION ALL BY NAME SELECT * FROM sale_moves",
        "r_movements",
        "sale_moves",
    ),
    "append_and_overwrite": _sql(
        "SELECT * FROM r_movements UNION ALL BY NAME SELECT * FROM sale_moves",
        "r_movements",
        "sale_moves",
    ),
    "combined_events": _sql(
        "SELECT * FROM r_clicks UNION ALL BY NAME SELECT * FROM order_clicks",
        "r_clicks",
        "order_clicks",
    ),
    "priced_orders": _sql(
        "SELECT order_id, customer_id, product_id, quantity, payment_method, order_status,"
        f" order_timestamp, {RUN_TS} AS processed_timestamp, price AS unit_price,"
        " round(quantity * price, 2) AS total_amount"
        " FROM r_orders JOIN r_products USING (product_id)",
        "r_orders",
        "r_products",
    ),
    "payment_amounts": _sql(
        """
        SELECT concat_ws('-', 'PAY', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS payment_id,
               order_id, l_returnflag AS payment_method, l_linestatus AS payment_status,
               'INR' AS currency, l_shipdate AS payment_timestamp,
               CAST(total_amount AS DOUBLE) AS amount
        FROM lineitem JOIN r_orders ON order_id = concat_ws('-', l_orderkey, l_linenumber)""",
        "r_orders",
    ),
    "csv_partition_roundtrip": _sql(_SILVER_ORDERS, "r_orders"),
    "orders_with_run_day": _sql(
        f"SELECT * EXCLUDE (year, month, day) FROM ({_SILVER_ORDERS})", "r_orders"
    ),
    "csv_text_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "dynamic_overwrite": _sql(_SILVER_ORDERS, "r_orders"),
    "clean_customers": _sql(
        "SELECT * REPLACE ('moved from ' || city AS city),"
        f" CAST(2001 AS INTEGER) AS year, CAST(8 AS INTEGER) AS month, CAST(1 AS INTEGER) AS day,"
        f" {RUN_TS} AS processed_timestamp FROM r_customers",
        "r_customers",
    ),
    "clean_inventory": f"""
        SELECT * EXCLUDE (rn), {_LANDED.format('event_timestamp')},
               {RUN_TS} AS processed_timestamp FROM (
            SELECT *, row_number() OVER (PARTITION BY inventory_event_id
                ORDER BY event_timestamp DESC, product_id, warehouse_id, movement_type,
                         quantity_change) AS rn
            FROM ({_CTE['r_movements'].replace('{lines}', 'lineitem')}))
        WHERE rn = 1""",
    "json_roundtrip": _sql(
        "SELECT session_id, customer_id, event_type, product_id, event_timestamp FROM r_clicks",
        "r_clicks",
    ),
    "audited_write": _sql(
        "SELECT count(*) AS rows_read, count(*) AS rows_written FROM"
        " (SELECT DISTINCT session_id, customer_id FROM r_clicks)",
        "r_clicks",
    ),
}
ORACLE |= {
    "scd2_compacted": ORACLE["scd2_published"],
    "fact_loaded_by_day": ORACLE["fact_orders"],
    "fact_as_table": ORACLE["fact_orders"],
}

_EVENT_ORDER = ", ".join(
    f"{c} NULLS FIRST" for c in [
        "source_updated_at", *[c.strip() for c in _HISTORY_COLUMNS.split(",") if c.strip() != "product_id"], "operation"])
_REPLAYED = _sql(
    f"""
    , events AS (
        SELECT {_HISTORY_COLUMNS}, operation, source_updated_at, min(processed_timestamp) AS processed_timestamp
        FROM (SELECT * FROM first_load UNION ALL BY NAME SELECT * FROM change_events)
        WHERE product_id IS NOT NULL AND operation IS NOT NULL GROUP BY ALL),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY {_EVENT_ORDER}) AS n FROM events),
    ends AS (
        SELECT v.product_id, v.n, min(c.n) AS end_n FROM numbered v
        JOIN numbered c ON c.product_id = v.product_id AND c.n > v.n AND c.operation IN ('U', 'D')
        GROUP BY v.product_id, v.n)
    SELECT {_qualified('v')}, v.source_updated_at AS effective_from, c.source_updated_at AS effective_to,
           e.end_n IS NULL AS is_current, v.processed_timestamp
    FROM numbered v
    LEFT JOIN ends e ON e.product_id = v.product_id AND e.n = v.n
    LEFT JOIN numbered c ON c.product_id = v.product_id AND c.n = e.end_n
    WHERE v.operation IN ('I', 'U')""",
    "first_load",
    "change_events",
)
ORACLE |= {
    "customers_by_landing": ORACLE["clean_customers"],
    "inventory_by_landing": ORACLE["clean_inventory"],
    "scd2_replayed": _REPLAYED,
    "scd2_late_batches": _REPLAYED,
    "funnel_from_bitmaps": ORACLE["gold_conversion_funnel"],
    "daily_sales_refreshed": ORACLE["gold_daily_sales"],
    "customers_mixed_headers": _sql(
        "SELECT * REPLACE (CASE WHEN CAST(customer_id AS BIGINT) % 3 <> 2 THEN preferred_category END"
        f" AS preferred_category), {RUN_TS} AS processed_timestamp FROM r_customers",
        "r_customers",
    ),
    "revenue_of_fourth_quarters": _sql(
        """
        SELECT CAST(year(order_timestamp) AS INTEGER) AS year, monthname(order_timestamp) AS month_name, category,
               CAST(sum(CAST(total_amount AS DECIMAL(10,2))) AS DOUBLE) AS revenue
        FROM r_orders JOIN r_products USING (product_id) WHERE quarter(order_timestamp) = 4 GROUP BY ALL""",
        "r_orders",
        "r_products",
    ),
    "revenue_by_product_bucketed": ORACLE["top_products_basic"],
    "checked_writes": _sql(
        """
        SELECT order_id, quantity, order_timestamp, count(*) OVER () AS rows_accepted,
               'change,outside quantity,repeats' AS refused_for
        FROM r_orders WHERE date_trunc('month', order_timestamp) = DATE '1998-03-01'""",
        "r_orders",
    ),
    "orders_of_a_status_in_order": _sql(
        """
        SELECT order_id, order_status,
               row_number() OVER w AS order_number,
               CAST(lag(total_amount) OVER w AS DOUBLE) AS previous_amount
        FROM r_orders
        WINDOW w AS (PARTITION BY order_status ORDER BY order_timestamp NULLS FIRST, order_id NULLS FIRST)""",
        "r_orders",
    ),
}
