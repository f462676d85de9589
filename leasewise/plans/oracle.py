"""The models once more in plain SQL, for the check against another engine.

Each `o_` entry is one SELECT over the sources (`b_`), the tables and other
entries.  It states the result directly (windows over whole keys, range
joins), without the measures the operators take for large data.
"""

from __future__ import annotations

from .bindings import BINDINGS, K, LINE, SETTINGS, chain

AS_OF = f"DATE '{SETTINGS.as_of}'"
FIRST = f"DATE '{SETTINGS.first_day}'"
MEMBER_NAME = "({0} ILIKE '%membership%' OR {0} ILIKE '%plan')"


def _fresh(c: str, op: str) -> str:
    return (f"(({c} {op} {AS_OF} - INTERVAL 35 DAY AND membership_type = 'monthly') "
            f"OR ({c} {op} {AS_OF} - INTERVAL 370 DAY AND membership_type = 'annual'))")


_FRESH, _STALE, _PROD = _fresh("last_membership_payment_ts", ">="), _fresh("last_membership_payment_ts", "<="), _fresh("last_product_payment_ts", ">=")
_JOINED = f"(CAST(first_membership_purchase_ts AS DATE) <= {AS_OF} OR membership_type = 'per-item')"
_CURRENT = f"({_FRESH} OR membership_type = 'per-item' OR ({_STALE} AND {_PROD}))"
_LAPSED = f"(NOT (({_FRESH} AND membership_type <> 'per-item') OR ({_STALE} AND {_PROD})))"
STATUS_CASE = f"""CASE
    WHEN {_JOINED} AND d = 0 AND a = 0 AND m = 0 THEN 1
    WHEN {_JOINED} AND d > 0 AND a = 0 AND m = 0 THEN 2
    WHEN {_JOINED} AND {_CURRENT} AND d - p <= 0 AND a > 1 AND a + d > p THEN 3
    WHEN {_JOINED} AND {_CURRENT} AND d - p > 0 AND a > 1 AND a + d > p THEN 4
    WHEN {_JOINED} AND {_CURRENT} AND d - p = 0 AND a = 1 AND a + d > p AND is_only_flagship_rented = 1
         AND first_delivery_date < {AS_OF} - INTERVAL 90 DAY THEN 12
    WHEN {_JOINED} AND {_CURRENT} AND d - p > 0 AND a = 1 AND a + d > p THEN 5
    WHEN {_JOINED} AND {_CURRENT} AND (d = 0 OR d = p) AND a = 1 AND (p = 0 OR d = p) THEN 6
    WHEN {_JOINED} AND {_CURRENT} AND d > 0 AND a = 0 AND m > 0 THEN 7
    WHEN {_JOINED} AND {_LAPSED} AND d - p <= 0 AND a > 0 THEN 9
    WHEN {_JOINED} AND {_CURRENT} AND d = 0 AND a = p AND a > 0 THEN 8
    WHEN membership_type <> 'per-item' AND CAST(first_membership_purchase_ts AS DATE) < {AS_OF} AND {_CURRENT} AND d = 0 AND a = 0 AND m > 0 THEN 10
    WHEN {_JOINED} AND {_LAPSED} AND d = 0 AND a = 0 THEN 11 END"""


def sessions_sql(source: str, actor: str, ts: str, event: str, gap: int) -> str:
    """Session ids by the textbook windows."""
    return f"""
        SELECT * EXCLUDE (cut), last_value(cut IGNORE NULLS) OVER (PARTITION BY {actor} ORDER BY {ts}, {event} ROWS UNBOUNDED PRECEDING) AS session_id
        FROM (SELECT *, CASE WHEN date_diff('second', lag({ts}) OVER (PARTITION BY {actor} ORDER BY {ts}, {event}), {ts}) > {gap}
                        OR lag({ts}) OVER (PARTITION BY {actor} ORDER BY {ts}, {event}) IS NULL THEN {event} END AS cut FROM {source})"""


def _first(c: str) -> str:
    return f"first({c} ORDER BY timestamp, id) FILTER (WHERE {c} IS NOT NULL)"


def _bin(c: str) -> str:
    return (f"CASE WHEN {c} < 50 THEN '< 50' WHEN {c} < 100 THEN '50 - 100' WHEN {c} < 150 THEN '100 - 150' "
            f"WHEN {c} < 200 THEN '150 - 200' WHEN {c} >= 200 THEN '200+' END")


_HEAD = "CASE WHEN instr({0}, '.') > 0 THEN split_part({0}, '.', 1) ELSE '' END"
RATE = "CAST({0} AS DECIMAL(24,6))"

ORACLE: dict[str, str] = {
    # --- identity ---
    "o_store": """
        SELECT c.id AS src_id, md5(lower(trim(c.email))) AS email_key, coalesce(v.member_id, md5(lower(trim(c.email)))) AS member_id
        FROM b_customers c LEFT JOIN b_overrides v ON v.src = 'shopify' AND v.src_id = c.id""",
    "o_idmap": """
        SELECT anonymous_id AS src_id, 'segment' AS src, email_key, member_id FROM (
            SELECT l.anonymous_id, s.email_key, s.member_id,
                   row_number() OVER (PARTITION BY l.anonymous_id ORDER BY l.timestamp, s.email_key, l.user_id) AS rn
            FROM (SELECT anonymous_id, user_id, timestamp FROM b_identifies UNION ALL SELECT * FROM b_landing_pages) l
            JOIN o_store s ON s.src_id = l.user_id) WHERE rn = 1
        UNION ALL SELECT src_id, 'shopify', email_key, member_id FROM o_store
        UNION ALL SELECT id, 'hubspot', md5(lower(trim(email))), md5(lower(trim(email))) FROM b_contacts""",
    "o_emails": "SELECT DISTINCT email_key, member_id FROM o_idmap",
    "o_messages": """
        SELECT m.id AS event_id, coalesce(e.member_id, md5(lower(trim(context_traits_email)))) AS member_id,
               context_traits_email AS email, timestamp AS event_ts, campaign_id, campaign_name, link_url
        FROM b_messages m LEFT JOIN o_emails e ON e.email_key = md5(lower(trim(context_traits_email)))""",
    # --- commerce ---
    "o_products": "SELECT id AS sku, title AS product_name FROM b_products",
    "o_prices": "SELECT p.id AS sku, min(v.price) AS avg_price FROM b_products p LEFT JOIN b_variants v ON v.product_id = p.id GROUP BY p.id",
    "o_lines": """
        SELECT id AS line_item_id, order_id, price, quantity, product_id AS sku, variant_id, gift_card AS is_gift_card, vendor,
               CASE WHEN discount_allocations <> '[]' THEN CAST(json_extract_string(discount_allocations, '$[0].amount') AS DECIMAL(18,2)) ELSE 0 END AS total_discount
        FROM b_line_items""",
    "o_heads": "SELECT *, json_extract_string(customer, '$.id') AS customer_id FROM b_orders",
    "o_codes": """
        SELECT order_id, json_extract_string(item, '$.code') AS discount_code, CAST(json_extract_string(item, '$.amount') AS DECIMAL(18,2)) AS discount_amount,
               json_extract_string(item, '$.type') AS discount_type
        FROM (SELECT id AS order_id, unnest(CAST(discount_codes AS JSON[])) AS item FROM b_orders)""",
    "o_gift_orders": """
        SELECT order_id FROM (SELECT l.order_id, count(*) AS n, sum(CASE WHEN p.title ILIKE '%gift card%' OR l.name ILIKE '%gift card%' THEN 1 ELSE 0 END) AS g
            FROM b_line_items l LEFT JOIN b_products p ON p.id = l.product_id GROUP BY 1) WHERE g > 0 AND n = g""",
    "o_membership_orders": """
        SELECT * FROM (
            SELECT c.email, i.member_id, o.created_at, p.title AS membership_product_name, o.id AS order_id, p.id AS product_id, s.avg_price AS membership_price,
                   row_number() OVER (PARTITION BY i.member_id ORDER BY o.created_at, o.id, p.id) AS rn
            FROM b_line_items l JOIN o_heads o ON o.id = l.order_id JOIN b_products p ON p.id = l.product_id
            LEFT JOIN b_customers c ON c.id = o.customer_id LEFT JOIN o_idmap i ON i.src = 'shopify' AND i.src_id = o.customer_id
            LEFT JOIN o_prices s ON s.sku = p.id
            WHERE p.title ILIKE '%member%' OR p.title ILIKE '%plan') WHERE rn = 1""",
    "o_orders": """
        SELECT o.id AS order_id, i.member_id, o.order_number, o.source_name AS order_type, o.created_at AS order_ts,
               CAST(o.total_discounts AS DECIMAL(18,2)) AS order_discounts, CAST(o.total_line_items_price AS DECIMAL(18,2)) AS order_gross,
               CAST(o.total_tax AS DECIMAL(18,2)) AS order_tax, CAST(o.total_price_usd AS DECIMAL(18,2)) AS order_total,
               o.id IN (SELECT order_id FROM o_membership_orders) AS is_membership_order,
               o.id IN (SELECT order_id FROM o_gift_orders) AS is_gift_card_order, o.financial_status, o.updated_at AS updated_ts,
               len(CAST(o.discount_codes AS JSON[])) AS n_codes
        FROM o_heads o LEFT JOIN o_idmap i ON i.src = 'shopify' AND i.src_id = o.customer_id""",
    "o_refunds": """
        SELECT json_extract_string(r, '$.id') AS refund_id, member_id, json_extract_string(r, '$.order_id') AS order_id,
               TRY_CAST(json_extract_string(r, '$.created_at') AS TIMESTAMP) AS created_ts,
               TRY_CAST(nullif(json_extract_string(r, '$.processed_at'), '') AS TIMESTAMP) AS processed_ts,
               coalesce(json_extract_string(r, '$.restock') = 'true', FALSE) AS restock,
               CAST(json_extract_string(r, '$.order_adjustments[0].amount') AS DECIMAL(18,2)) AS order_adjustments, r
        FROM (SELECT i.member_id, unnest(CAST(o.refunds AS JSON[])) AS r FROM o_heads o LEFT JOIN o_idmap i ON i.src = 'shopify' AND i.src_id = o.customer_id)""",
    "o_refund_lines": """
        SELECT refund_id, order_id, json_extract_string(l, '$.id') AS refund_line_item_id, nullif(json_extract_string(l, '$.line_item_id'), '') AS line_item_id,
               TRY_CAST(json_extract_string(l, '$.quantity') AS INT) AS quantity, json_extract_string(l, '$.restock_type') AS restock_type,
               TRY_CAST(nullif(json_extract_string(l, '$.subtotal'), '') AS DECIMAL(18,2)) AS subtotal, TRY_CAST(nullif(json_extract_string(l, '$.total_tax'), '') AS DECIMAL(18,2)) AS total_tax,
               TRY_CAST(json_extract_string(l, '$.total_discount') AS DECIMAL(18,2)) AS total_discount,
               json_extract_string(l, '$.requires_shipping') AS requires_shipping, TRY_CAST(json_extract_string(l, '$.price') AS DECIMAL(18,2)) AS price
        FROM (SELECT refund_id, order_id, unnest(CAST(json_extract(r, '$.refund_line_items') AS JSON[])) AS l FROM o_refunds)""",
    # The ledger as three kinds of movements, then one pass that names them.
    "o_moves": """
        SELECT 'order' AS sales_type, o.order_id, o.member_id, l.line_item_id, o.order_ts AS moved_ts, l.sku AS item, l.quantity, l.price * l.quantity AS gross, l.total_discount AS less, 0 AS back,
               l.price * coalesce(l.quantity, 1) - l.total_discount AS net, o.order_tax AS tax, l.price * l.quantity - l.total_discount AS total
        FROM o_lines l JOIN o_orders o ON o.order_id = l.order_id
        UNION ALL
        SELECT 'return', r.order_id, r.member_id, f.line_item_id, r.created_ts, l.sku, -f.quantity, 0, coalesce(f.total_discount, 0), coalesce(-f.subtotal, r.order_adjustments),
               coalesce(-f.subtotal, r.order_adjustments), f.total_tax, coalesce(-f.subtotal, r.order_adjustments)
        FROM o_refunds r LEFT JOIN o_refund_lines f ON f.refund_id = r.refund_id AND f.order_id = r.order_id LEFT JOIN o_lines l ON l.line_item_id = f.line_item_id
        UNION ALL
        SELECT 'return', order_id, member_id, NULL, created_ts, NULL, 0, order_adjustments, 0, 0, order_adjustments, 0, order_adjustments FROM o_refunds WHERE order_adjustments > 0""",
    "o_ledger": """
        SELECT v.order_id, v.member_id, line_item_id, moved_ts AS transaction_ts, o.order_number, o.order_type, sales_type, c.label AS sales_channel, p.product_name, p.sku, v.quantity,
               gross AS gross_sales, less AS discounts, back AS returns, net AS net_sales, tax AS taxes, total AS total_sales
        FROM o_moves v LEFT JOIN o_orders o ON o.order_id = v.order_id LEFT JOIN o_products p ON p.sku = v.item
        LEFT JOIN (VALUES ('web', 'Online Store'), ('shopify_draft_order', 'Draft Orders'), ('subscription_contract', 'Bold Subscriptions'), ('3890849', 'Shop'), ('580111', 'Registry Storefront'))
             c(kind, label) ON c.kind = o.order_type""",
    "o_special": f"""
        SELECT DISTINCT member_id FROM o_ledger WHERE sales_type = 'return' AND quantity = 0 AND product_name IS NULL AND gross_sales >= 80
        AND member_id IN (SELECT member_id FROM o_ledger WHERE quantity < 0 AND {MEMBER_NAME.format('product_name')})""",
    "o_offsets": """
        SELECT member_id, CAST(order_ts AS DATE) AS start_date, CAST(order_ts AS DATE) + 90 AS end_date, sum(-order_discounts) AS discount_mrr_offset
        FROM o_orders WHERE order_type = 'web' AND order_discounts > 0 AND NOT is_membership_order GROUP BY ALL""",
    "o_order_baskets": f"""
        WITH r AS (SELECT o.member_id, o.order_ts, l.price * l.quantity AS amount, l.total_discount, p.product_name, l.sku,
                          dense_rank() OVER (PARTITION BY o.member_id ORDER BY o.order_ts) AS dense_rank
                   FROM o_orders o LEFT JOIN o_lines l ON l.order_id = o.order_id LEFT JOIN o_products p ON p.sku = l.sku WHERE o.order_type <> 'subscription_contract')
        SELECT member_id, order_ts, dense_rank, count(*) AS basket_ct,
               sum(CASE WHEN NOT (product_name ILIKE '%plan' OR product_name ILIKE '%membership') THEN amount END) AS basket_dollars,
               sum(CASE WHEN product_name ILIKE '%plan' OR product_name ILIKE '%membership' THEN amount END) AS membership_dollars,
               max(CASE WHEN sku IS NULL THEN NULL WHEN sku = '{SETTINGS.flagship_sku}' THEN 1 ELSE 0 END) AS has_flagship,
               string_agg(product_name, ', ' ORDER BY product_name) AS basket_products, coalesce(sum(total_discount), 0) AS total_discounts,
               sum(amount) - sum(total_discount) AS net_basket_size, {_bin('sum(CASE WHEN NOT (product_name ILIKE $$%plan$$ OR product_name ILIKE $$%membership$$) THEN amount END)')} AS basket_bin
        FROM r GROUP BY 1, 2, 3""",
    # --- rentals ---
    "o_rentals": f"""
        WITH d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY related_order_line_ref ORDER BY date_modified DESC, record_id DESC) AS rn
                     FROM b_schedule_delivery WHERE delivery_status <> 'Scheduled Delivery Cancelled') WHERE rn = 1),
        u AS (SELECT * FROM (SELECT *, delivery_performance_picking_scheduled_delivery_related_order_line_ref AS ref,
                     row_number() OVER (PARTITION BY delivery_performance_picking_scheduled_delivery_related_order_line_ref ORDER BY date_modified DESC, record_id DESC) AS rn
                     FROM b_schedule_pickup WHERE scheduled_pickup_status <> 'Scheduled Pickup Cancelled') WHERE rn = 1),
        k AS (SELECT DISTINCT asset_tag_association_asset_tag AS bin, scheduled_delivery_related_order_line AS line FROM b_pick_deliveries)
        SELECT k.bin, i.member_id, split_part(l.id, '.', 1) AS line_item_id, l.qb_item_sku AS sku, {_HEAD.format('l.order_id')} AS order_id,
               CAST(nullif(d.scheduled_delivery_date, '') AS DATE) AS delivery_date, CAST(nullif(u.scheduled_pickup_date, '') AS DATE) AS pick_up_date,
               coalesce(CAST(nullif(l.price, '') AS DECIMAL(18,2)), s.avg_price) AS avg_price,
               CASE WHEN l.order_id_qb_inventory_location_inventory_location_name ILIKE 'bay %' THEN 'SF'
                    WHEN l.order_id_qb_inventory_location_inventory_location_name ILIKE 'ny %' THEN 'NYC' END AS ops_location
        FROM b_order_lines l LEFT JOIN o_products p ON p.sku = l.qb_item_sku LEFT JOIN d ON d.related_order_line_ref = l.id
        LEFT JOIN k ON k.line = d.related_order_line LEFT JOIN u ON u.ref = l.id
        LEFT JOIN b_ops_customers c ON CAST(CAST(c.id AS BIGINT) AS VARCHAR) = {_HEAD.format('l.qb_order_related_customer')}
        LEFT JOIN o_idmap i ON i.src = 'hubspot' AND i.src_id = c.hubspot_id LEFT JOIN o_prices s ON s.sku = l.qb_item_sku
        WHERE l.qb_ol_status NOT IN ('Closed-Refunded', 'Closed-Non-inventory', 'Closed-Duplicate', 'Closed-Registry', 'Closed-Test', 'Closed-Trial', 'Closed')
          AND p.product_name NOT ILIKE '% plan%' AND p.product_name NOT ILIKE '%membership%'""",
    "o_items": """
        SELECT i.asset_tag AS bin, i.item_sku AS sku, i.item_category AS category, i.item_name, i.merchant AS store, i.payment_method AS purchase_method, i.inventory_status AS bin_status,
               i.inventory_location_inventory_location_name AS location, i.receipt_document AS tracking_info, CAST(nullif(i.estimated_arrival_date, '') AS DATE) AS estimated_actual_arrival,
               CAST(replace(i.cost_pretax_price, '$', '') AS DECIMAL(18,2)) AS retail_price, CAST(nullif(i.cost_sales_tax, '') AS DECIMAL(18,2)) AS actual_tax_cost,
               CAST(replace(i.cost_shipping, '$', '') AS DECIMAL(18,2)) AS actual_shipping_cost, CAST(x.scrap_date AS DATE) AS scrap_date, CAST(nullif(i.purchase_date, '') AS DATE) AS purchase_date,
               CAST(replace(replace(i.cost_pretax_price, ',', ''), '$', '') AS DECIMAL(18,2)) AS actual_purchase_price,
               CAST(replace(replace(i.cost_total, ',', ''), '$', '') AS DECIMAL(18,2)) AS actual_total_cost,
               CAST(nullif(t.asset_build_time_actual, '') AS DOUBLE) AS assembly_time, nullif(i.date_asset_received, '') IS NOT NULL AS received,
               s.asset IS NOT NULL AS asset_sold, CAST(s.asset_sale_date AS DATE) AS asset_sale_date, CAST(nullif(s.sale_amount, '') AS DECIMAL(18,2)) AS asset_sale_amount,
               x.record_id IS NOT NULL AS asset_scrapped,
               CASE WHEN i.inventory_location_inventory_location_name ILIKE '%bay%' THEN 'SF' WHEN i.inventory_location_inventory_location_name ILIKE 'NY %' THEN 'NY' END AS ops_location
        FROM b_inventory i LEFT JOIN b_associate_asset_tag t USING (asset_tag)
        LEFT JOIN (SELECT asset_tag_association_asset_tag AS asset, arg_max(asset_sale_date, record_id) AS asset_sale_date, arg_max(sale_amount, record_id) AS sale_amount
                   FROM b_sell_asset GROUP BY 1) s ON s.asset = i.asset_tag
        LEFT JOIN b_scrap_asset x ON x.asset_tag_association_asset_tag = i.asset_tag""",
    "o_days": f"SELECT CAST(unnest(generate_series({FIRST}, {AS_OF}, INTERVAL 1 DAY)) AS DATE) AS date",
    "o_rental_baskets": f"""
        WITH r AS (SELECT r.member_id, r.delivery_date, r.order_id, r.avg_price, r.sku, p.product_name, f.discount,
                          dense_rank() OVER (PARTITION BY r.member_id ORDER BY r.delivery_date) AS dense_rank
                   FROM o_rentals r LEFT JOIN o_products p ON p.sku = r.sku
                   LEFT JOIN (SELECT order_id, sku, sum(total_discount) AS discount FROM o_lines GROUP BY 1, 2) f ON f.order_id = r.order_id AND f.sku = r.sku),
        dues AS (SELECT o.member_id, sum(l.price) AS member_dues FROM o_lines l JOIN o_products p ON p.sku = l.sku JOIN o_orders o ON o.order_id = l.order_id
                 WHERE p.product_name ILIKE '%annual%' OR p.product_name ILIKE '%monthly%' GROUP BY 1)
        SELECT r.member_id, delivery_date, dense_rank, count(*) AS basket_ct, sum(avg_price) AS basket_dollars, sum(d.member_dues) AS membership_dollars,
               max(CASE WHEN sku = '{SETTINGS.flagship_sku}' THEN 1 ELSE 0 END) AS has_flagship, string_agg(product_name, ', ' ORDER BY product_name) AS basket_products,
               sum(discount) AS total_discounts, sum(avg_price) - sum(discount) AS net_basket_size, {_bin('sum(avg_price)')} AS basket_bin
        FROM r LEFT JOIN dues d ON d.member_id = r.member_id GROUP BY 1, 2, 3""",
    "o_sku_agg": f"""
        WITH stock AS (SELECT sku, count(bin) AS inventory_count,
                avg(CASE WHEN purchase_date > DATE '1990-01-01' THEN date_diff('day', purchase_date, f.began) END) AS dwell_time,
                sum(CASE WHEN purchase_date > DATE '1990-01-01' THEN date_diff('day', purchase_date, {AS_OF}) END) AS total_inventory_days,
                sum(CASE WHEN purchase_date > DATE '1990-01-01' THEN date_diff('day', purchase_date, f.began) END) AS total_dwell
              FROM o_items LEFT JOIN (SELECT bin, min(delivery_date) AS began FROM o_rentals GROUP BY 1) f USING (bin) GROUP BY 1),
        use AS (SELECT sku, count(DISTINCT CASE WHEN {AS_OF} >= delivery_date AND ({AS_OF} <= pick_up_date OR pick_up_date IS NULL) AND bin <> '' THEN bin END) AS active_count,
                count(1) AS rental_count, avg(CASE WHEN pick_up_date IS NOT NULL THEN date_diff('day', delivery_date, pick_up_date) END) AS avg_completed_duration,
                avg(CASE WHEN pick_up_date IS NULL THEN date_diff('day', delivery_date, {AS_OF}) END) AS avg_active_duration,
                count(DISTINCT member_id) AS total_members,
                sum(CASE WHEN {AS_OF} >= delivery_date AND ({AS_OF} <= pick_up_date OR pick_up_date IS NULL) THEN avg_price ELSE 0 END) AS current_mrr,
                sum(CASE WHEN delivery_date < {AS_OF} THEN date_diff('day', delivery_date, coalesce(pick_up_date, {AS_OF})) END) AS total_rental_days
              FROM o_rentals GROUP BY 1),
        rev AS (SELECT sku, sum(CAST(avg_price * 12 / 365 AS DECIMAL(24,6))) AS total_revenue FROM o_days d JOIN o_rentals r
                ON d.date >= r.delivery_date AND d.date < coalesce(r.pick_up_date, DATE '9999-12-31') WHERE d.date < {AS_OF} GROUP BY 1)
        SELECT p.sku, p.product_name, inventory_count, active_count, rental_count, avg_completed_duration, avg_active_duration, dwell_time,
               CASE WHEN use.sku IS NOT NULL THEN coalesce(total_revenue, 0) END AS total_revenue, total_members, current_mrr, total_inventory_days, total_rental_days,
               total_inventory_days - total_dwell AS non_dwell_inventory_days
        FROM o_products p LEFT JOIN stock USING (sku) LEFT JOIN use USING (sku) LEFT JOIN rev USING (sku)""",
    # --- lifecycle ---
    "o_settled": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id, line_item_id, abs(quantity)
                          ORDER BY transaction_ts DESC NULLS FIRST, net_sales ASC NULLS LAST, sales_type DESC, sku ASC NULLS LAST) AS rn FROM o_ledger) WHERE rn = 1 AND net_sales >= 0""",
    "o_payment_agg": "SELECT member_id, " + ", ".join(
        f"{f}(CASE WHEN product_name ILIKE '{p}' AND (product_name ILIKE '%member%' OR product_name ILIKE '%plan') THEN transaction_ts END) AS {f}_{n}_payment_ts"
        for n, p in (("month", "%month%"), ("annual", "%annual%"), ("per_item", "%per%item%")) for f in ("min", "max")) + f""",
        max(CASE WHEN NOT (product_name ILIKE '%member%' OR product_name ILIKE '%plan') THEN transaction_ts END) AS max_product_payment_ts,
        count(DISTINCT CASE WHEN transaction_ts >= {AS_OF} - INTERVAL 35 DAY AND NOT (product_name ILIKE '%member%' OR product_name ILIKE '%plan') THEN sku END) AS active_sku_ct
        FROM o_settled GROUP BY 1""",
    "o_group": f"SELECT sku FROM o_products WHERE product_name ILIKE '{SETTINGS.flagship_pattern}'",
    "o_payment_inputs": f"""
        WITH t AS (SELECT DISTINCT l.member_id, l.transaction_ts, CASE WHEN g.sku IS NOT NULL THEN 'FLAGSHIP_GROUP' ELSE l.sku END AS sku,
                coalesce({MEMBER_NAME.format('l.product_name')}, FALSE) OR coalesce(s.member_id IS NOT NULL AND sales_type = 'return' AND l.quantity = 0 AND product_name IS NULL AND gross_sales >= 80, FALSE) AS is_membership,
                CASE WHEN product_name ILIKE '%gift card%' THEN 1 WHEN nullif(product_name, '') IS NOT NULL THEN 0 END AS gift,
                CASE WHEN v.title ILIKE '%month%' THEN 1 ELSE 0 END AS registry
            FROM o_settled l LEFT JOIN o_lines i ON i.line_item_id = l.line_item_id LEFT JOIN b_variants v ON v.id = i.variant_id
            LEFT JOIN o_special s ON s.member_id = l.member_id LEFT JOIN o_group g ON g.sku = l.sku)
        SELECT member_id, min(CASE WHEN is_membership THEN transaction_ts END) AS first_membership_purchase_ts,
               max(CASE WHEN is_membership THEN transaction_ts END) AS last_membership_payment_ts, max(CASE WHEN NOT is_membership THEN transaction_ts END) AS last_product_payment_ts,
               count(DISTINCT CASE WHEN NOT is_membership AND transaction_ts >= {AS_OF} - INTERVAL 35 DAY THEN sku END) AS ct_active_product_payments,
               count(DISTINCT CASE WHEN NOT is_membership THEN sku END) AS ct_purchased_skus, max(CASE WHEN sku IS NULL THEN NULL WHEN sku = 'FLAGSHIP_GROUP' THEN 1 ELSE 0 END) AS is_ever_purchased_flagship,
               avg(gift) AS avg_purchased_gift_card, avg(registry) AS avg_purchased_registry_product,
               max(CASE WHEN member_id IN (SELECT o.member_id FROM o_codes c JOIN o_orders o USING (order_id) WHERE c.discount_code ILIKE '{SETTINGS.influencer_pattern}' AND o.member_id IS NOT NULL) THEN 1 ELSE 0 END) AS is_influencer
        FROM t GROUP BY 1""",
    "o_rental_inputs": f"""
        WITH r AS (SELECT member_id, delivery_date AS d, pick_up_date AS p, CASE WHEN g.sku IS NOT NULL THEN 'FLAGSHIP_GROUP' ELSE r.sku END AS sku FROM o_rentals r LEFT JOIN o_group g ON g.sku = r.sku)
        SELECT member_id, count(DISTINCT CASE WHEN d <= {AS_OF} AND coalesce(p, DATE '9999-12-31') >= {AS_OF} THEN sku END) AS ct_active_products,
               count(DISTINCT CASE WHEN d > {AS_OF} THEN sku END) AS ct_items_with_scheduled_delivery, count(DISTINCT CASE WHEN p > {AS_OF} THEN sku END) AS ct_items_with_scheduled_pickup,
               count(DISTINCT CASE WHEN d <= {AS_OF} THEN sku END) AS ct_skus_delivered, min(CASE WHEN sku = 'FLAGSHIP_GROUP' THEN 1 ELSE 0 END) AS is_only_flagship_rented, min(d) AS first_delivery_date
        FROM r GROUP BY 1""",
    "o_inputs": """
        SELECT *, CASE WHEN is_ever_purchased_flagship IS NULL AND ct_purchased_skus = 1 THEN NULL WHEN is_ever_purchased_flagship = 1 AND ct_purchased_skus = 1 THEN 1
                       WHEN is_ever_purchased_flagship IS NULL AND ct_purchased_skus IS NULL THEN NULL ELSE 0 END AS is_only_flagship_paid
        FROM o_payment_inputs FULL OUTER JOIN o_rental_inputs USING (member_id)""",
    "o_members": f"""
        WITH contact AS (SELECT * FROM (SELECT i.member_id, c.*, row_number() OVER (PARTITION BY i.member_id ORDER BY coalesce(i.email_key = i.member_id, FALSE) DESC, c.id) AS rn
                FROM b_contacts c LEFT JOIN o_idmap i ON i.src = 'hubspot' AND i.src_id = c.id WHERE c.email NOT ILIKE '%corp.example.com%') WHERE rn = 1),
        placed AS (SELECT member_id, CAST(min(CASE WHEN NOT is_membership_order THEN order_ts END) AS DATE) AS item_dt, CAST(min(CASE WHEN is_membership_order THEN order_ts END) AS DATE) AS plan_dt
                FROM o_orders WHERE NOT is_gift_card_order AND financial_status <> 'refunded' GROUP BY 1),
        trips AS (SELECT member_id, min(coalesce(delivery_date, DATE '9999-12-31')) AS first_d, max(coalesce(pick_up_date, DATE '9999-12-31')) AS last_p FROM o_rentals GROUP BY 1),
        shared AS (SELECT i.member_id, min(o.created_at) AS shared_offer_ts FROM o_heads o JOIN o_idmap i ON i.src = 'shopify' AND i.src_id = o.customer_id
                   WHERE discount_codes ILIKE '{SETTINGS.sharing_pattern}' GROUP BY 1),
        crm AS (SELECT member_id, max(src_id) AS hubspot_customer_id FROM o_idmap WHERE src = 'hubspot' GROUP BY 1),
        base AS (SELECT c.member_id, crm.hubspot_customer_id, c.email, c.firstname AS first_name, c.lastname AS last_name, substring(c.lastname, 1, 1) AS last_initial, c.state,
                c.membership_type AS crm_type, CASE WHEN nullif(c.hs_lifecyclestage_customer_date, '') IS NOT NULL OR nullif(c.membership_type, '') IS NOT NULL THEN TRUE ELSE FALSE END AS has_crm,
                greatest(child_1_dob, child_2_dob, child_3_dob) AS youngest_child_dob, (child_1_dob IS NOT NULL)::INT + (child_2_dob IS NOT NULL)::INT + (child_3_dob IS NOT NULL)::INT AS number_of_children,
                c.created_at AS contact_created_ts, c.hs_analytics_source, c.hs_analytics_source_data_1 AS hs_analytics_source_data, c.child_1_dob, c.child_2_dob, c.child_3_dob, c.expecting_at_sign_up,
                c.city, c.address, c.zip, c.reason_for_canceling, c.monthly_membership_end_date,
                least(coalesce(v.membership_first_purchase_dt, DATE '9999-12-31'), coalesce(CAST(a.min_month_payment_ts AS DATE), DATE '9999-12-31'), coalesce(CAST(a.min_annual_payment_ts AS DATE), DATE '9999-12-31'),
                      coalesce(CAST(a.min_per_item_payment_ts AS DATE), DATE '9999-12-31'), coalesce(CASE WHEN s.member_id IS NOT NULL THEN o.item_dt END, DATE '9999-12-31'),
                      coalesce(CASE WHEN m.ct_active_product_payments > 0 AND m.avg_purchased_gift_card < 1 AND m.avg_purchased_registry_product < 1 THEN o.item_dt END, DATE '9999-12-31')) AS start_dt,
                CASE WHEN a.max_annual_payment_ts IS NOT NULL AND a.max_month_payment_ts IS NOT NULL THEN CASE WHEN a.max_annual_payment_ts >= a.max_month_payment_ts THEN 'annual' ELSE 'monthly' END
                     WHEN a.max_annual_payment_ts IS NOT NULL THEN 'annual' WHEN a.max_month_payment_ts IS NOT NULL THEN 'monthly' WHEN a.max_per_item_payment_ts IS NOT NULL THEN 'per-item' END AS billing,
                s.member_id IS NOT NULL AS is_special, p.membership_product_name, shared.shared_offer_ts, o.item_dt, t.first_d, t.last_p, m.* EXCLUDE (member_id),
                coalesce(m.ct_items_with_scheduled_delivery, 0) AS d, coalesce(m.ct_items_with_scheduled_pickup, 0) AS p, coalesce(m.ct_active_products, 0) AS a, coalesce(m.ct_skus_delivered, 0) AS m
            FROM contact c LEFT JOIN o_payment_agg a USING (member_id) LEFT JOIN o_inputs m USING (member_id) LEFT JOIN placed o USING (member_id) LEFT JOIN trips t USING (member_id)
            LEFT JOIN o_membership_orders p USING (member_id) LEFT JOIN o_special s USING (member_id) LEFT JOIN b_member_overrides v USING (member_id)
            LEFT JOIN shared USING (member_id) LEFT JOIN crm USING (member_id) WHERE coalesce(v.is_blacklist_member, 0) <> 1),
        typed AS (SELECT *, CASE WHEN is_special THEN 'annual' WHEN is_influencer = 1 THEN 'influencer' WHEN avg_purchased_gift_card = 1 THEN 'gift-card-buyer'
                WHEN avg_purchased_registry_product = 1 THEN 'registry-product-buyer' WHEN start_dt > {AS_OF} THEN CASE WHEN ct_active_product_payments > 0 THEN 'per-item' ELSE 'lead' END
                WHEN billing IS NOT NULL THEN billing WHEN crm_type ILIKE '%item%' OR membership_product_name ILIKE '%item%' THEN 'per-item' WHEN has_crm THEN 'per-item' ELSE 'lead' END AS membership_type FROM base),
        cased AS (SELECT *, {STATUS_CASE} AS status_case FROM typed),
        named AS (SELECT *, CASE WHEN status_case IN (1, 2) THEN 'Pre Active' WHEN status_case = 11 THEN 'Churned' WHEN status_case IS NOT NULL THEN 'Active' END AS member_status FROM cased)
        SELECT member_id, hubspot_customer_id, email, first_name, last_name, last_initial, nullif(start_dt, DATE '9999-12-31') AS membership_start_dt,
               CASE WHEN member_status = 'Churned' AND membership_type = 'annual' THEN CAST(last_membership_payment_ts AS DATE) + 370
                    WHEN member_status = 'Churned' AND membership_type = 'monthly' THEN CAST(last_membership_payment_ts AS DATE) + 35
                    WHEN member_status = 'Churned' THEN nullif(last_p, DATE '9999-12-31') END AS membership_end_dt,
               membership_type, youngest_child_dob, number_of_children, monthly_membership_end_date, shared_offer_ts IS NOT NULL AS is_shared_offer, shared_offer_ts,
               nullif(least(coalesce(item_dt, DATE '9999-12-31'), coalesce(first_d, DATE '9999-12-31')), DATE '9999-12-31') AS first_item_order_dt,
               nullif(first_d, DATE '9999-12-31') AS first_delivery_dt, nullif(last_p, DATE '9999-12-31') AS last_pick_up_dt,
               CASE WHEN state ILIKE '%n_1%' THEN 'SF' WHEN state ILIKE '%n_2%' OR state ILIKE '%n_3%' THEN 'NYC' ELSE 'Other' END AS ops_location,
               first_membership_purchase_ts, last_membership_payment_ts, last_product_payment_ts, ct_active_product_payments, ct_purchased_skus, ct_active_products,
               ct_items_with_scheduled_delivery, ct_items_with_scheduled_pickup, ct_skus_delivered, is_only_flagship_rented, first_delivery_date, status_case, member_status,
               contact_created_ts, hs_analytics_source, hs_analytics_source_data, child_1_dob, child_2_dob, child_3_dob, expecting_at_sign_up, city, address, zip, state, reason_for_canceling,
               is_ever_purchased_flagship, is_only_flagship_paid,
               CASE status_case WHEN 1 THEN 'Unscheduled' WHEN 2 THEN 'Scheduled' WHEN 3 THEN 'Engaged' WHEN 4 THEN 'Engaged' WHEN 5 THEN '1 Item only' WHEN 6 THEN '1 Item only'
                    WHEN 7 THEN 'Re-engaging' WHEN 8 THEN 'At Risk' WHEN 9 THEN 'Churn Pending' WHEN 10 THEN 'Churn Pending' WHEN 11 THEN 'Churned' WHEN 12 THEN 'At Risk' END AS member_sub_status,
               CASE status_case WHEN 1 THEN 'Pre Active - Unscheduled' WHEN 2 THEN 'Pre Active - Scheduled' WHEN 3 THEN 'Multiple Items' WHEN 4 THEN 'Growing basket' WHEN 5 THEN 'Growing basket'
                    WHEN 6 THEN 'Maintaining' WHEN 7 THEN 'No active items, but active membership' WHEN 8 THEN 'Pickups scheduled' WHEN 9 THEN 'Payments Stopped' WHEN 10 THEN 'Pickups made'
                    WHEN 11 THEN 'Churned' WHEN 12 THEN 'Flagship only >3mo' END AS member_status_detail
        FROM named""",
    "o_memberships": f"""
        SELECT member_id, membership_start_dt AS start_dt, membership_end_dt AS end_dt, membership_type,
               CASE WHEN membership_end_dt IS NULL OR membership_end_dt >= {AS_OF} THEN 'active' ELSE 'inactive' END AS status,
               CASE membership_type WHEN 'annual' THEN 149 WHEN 'monthly' THEN 18 ELSE 0 END AS price FROM o_members WHERE membership_start_dt <= {AS_OF}""",
    "o_revenue": f"""
        SELECT member_id, sku, NULL AS membership_type, d.date, CAST(avg_price * 12 / 365 AS DECIMAL(24,6)) AS revenue FROM o_days d JOIN o_rentals r
        ON d.date >= r.delivery_date AND d.date < coalesce(r.pick_up_date, DATE '9999-12-31')
        UNION ALL SELECT member_id, NULL, membership_type, d.date, CAST(CASE WHEN membership_type = 'annual' THEN price / 365 ELSE price * 12 / 365 END AS DECIMAL(24,6))
        FROM o_days d JOIN o_memberships m ON d.date >= m.start_dt AND d.date < coalesce(m.end_dt, DATE '9999-12-31') WHERE membership_type <> 'per-item'""",
    # --- web ---
    "o_known": """
        SELECT e.*, coalesce(a.member_id, b.member_id, e.user_id, e.anonymous_id) AS master_user_id FROM b_events e
        LEFT JOIN o_idmap a ON a.src = 'segment' AND a.src_id = e.anonymous_id LEFT JOIN o_idmap b ON b.src = 'shopify' AND b.src_id = e.user_id""",
    "o_sessioned": sessions_sql("o_known", "master_user_id", "timestamp", "id", SETTINGS.session_gap_s),
    "o_session_attributes": f"""
        SELECT session_id, min(master_user_id) AS master_user_id, {_first('context_campaign_name')} AS session_campaign_name, {_first('context_campaign_content')} AS session_campaign_content,
               {_first('context_campaign_source')} AS session_campaign_source, {_first('context_campaign_medium')} AS session_campaign_medium,
               first(referrer ORDER BY timestamp, id) AS session_referrer, max(CASE WHEN url ILIKE '%gclid%' THEN 1 ELSE 0 END) AS session_has_gclid,
               first(regexp_extract(url, 'gclid=([^&]+)', 1) ORDER BY timestamp, id) FILTER (WHERE url LIKE '%gclid=%') AS session_gcl_id,
               max(CASE WHEN url ILIKE '%source=referral%' THEN 1 ELSE 0 END) AS is_referral_session, min(timestamp) AS session_start_ts, max(timestamp) AS session_end_ts,
               max(CASE WHEN url ILIKE '%-dev.%' THEN 1 ELSE 0 END) AS is_dev_session, sum(CASE WHEN src_tbl = 'pages' THEN 1 ELSE 0 END) AS session_page_views,
               split_part(first(url ORDER BY timestamp, id), '?', 1) AS session_first_url
        FROM o_sessioned GROUP BY 1""",
    "o_campaigns": """
        SELECT md5('google-' || c.id) AS campaign_id, c.id AS src_campaign_id, c.name AS campaign_name, c.status,
               max(CASE WHEN a.type ILIKE '%search%' THEN 'adwords_search' WHEN a.type ILIKE '%image%' THEN 'adwords_display' END) AS channel_id
        FROM b_ad_campaigns c LEFT JOIN b_ad_groups g ON g.campaign_id = c.id LEFT JOIN b_ads a ON a.ad_group_id = g.id GROUP BY ALL
        UNION ALL SELECT md5('facebook-' || id), id, name, effective_status, 'facebook_ads' FROM b_social_campaigns""",
    "o_sessions": """
        SELECT s.*, g.campaign_id AS ad_campaign_id, CASE
            WHEN session_has_gclid = 1 AND g.channel_id IS NOT NULL THEN g.channel_id WHEN session_has_gclid = 1 THEN 'adwords_search' WHEN is_referral_session = 1 THEN 'referral'
            WHEN session_campaign_source ILIKE '%facebook%' AND session_campaign_medium = 'cpc' AND session_referrer ILIKE '%insta%' THEN 'instagram_ads'
            WHEN session_campaign_source ILIKE '%facebook%' AND session_campaign_medium = 'cpc' THEN 'facebook_ads' WHEN session_campaign_source = 'partner' THEN 'sc_partner'
            WHEN session_campaign_source = 'liveintent' AND session_campaign_medium = 'cpc' THEN 'liveintent'
            WHEN session_referrer ILIKE '%google%' THEN 'google_search' WHEN session_referrer ILIKE '%bing%' THEN 'bing_search' WHEN session_referrer ILIKE '%facebook%' THEN 'facebook_organic'
            WHEN session_referrer ILIKE '%instagram%' THEN 'instagram_organic' WHEN session_referrer ILIKE '%shareasale%' THEN 'shareasale'
            WHEN session_referrer ILIKE '%shop.example.com%' THEN 'internal' ELSE 'direct' END AS session_channel_id
        FROM o_session_attributes s LEFT JOIN (SELECT gcl_id, min(campaign_id) AS campaign_id FROM b_clicks GROUP BY 1) c ON c.gcl_id = s.session_gcl_id
        LEFT JOIN o_campaigns g ON g.src_campaign_id = c.campaign_id AND g.channel_id IN ('adwords_search', 'adwords_display')
        WHERE is_dev_session = 0""",
    "o_touches": """
        SELECT DISTINCT master_user_id, """ + ", ".join(
        f"first_value(session_{c}) OVER (PARTITION BY master_user_id ORDER BY session_start_ts, session_id) AS user_first_session_{c}, "
        f"first_value(session_{c}) OVER (PARTITION BY master_user_id ORDER BY session_start_ts DESC, session_id DESC) AS user_last_session_{c}"
        for c in ("channel_id", "campaign_name", "campaign_content", "campaign_source", "campaign_medium")) + " FROM o_sessions",
    # Only the first visit takes in development sessions.
    "o_visitors": "SELECT master_user_id, min(timestamp) AS user_first_visit_ts, first(d ORDER BY timestamp, id) FILTER (WHERE d IS NOT NULL AND kept) AS session_device_type, " + ", ".join(
        f"max(CASE WHEN kept AND v = '{v}' AND context_page_referrer = 'https://shop.example.com/' THEN 1 ELSE 0 END) AS is_{n}_module" for n, v in SETTINGS.modules.items()) + """
        FROM (SELECT e.*, session_id IN (SELECT session_id FROM o_sessions) AS kept, regexp_extract(url, '.*pf_c_collection=([^&]*)', 1) AS v,
                     CASE WHEN context_user_agent ILIKE '%iphone%' THEN 'iPhone' WHEN context_user_agent ILIKE '%android%' THEN 'Android' WHEN context_user_agent ILIKE '%ipad%' THEN 'iPad'
                          WHEN context_user_agent IS NOT NULL THEN 'PC' END AS d FROM o_sessioned e) GROUP BY 1""",
    "o_web": """
        SELECT e.*, s.* EXCLUDE (session_id, master_user_id), t.* EXCLUDE (master_user_id), v.* EXCLUDE (master_user_id), coalesce(m1.member_id, m2.member_id) AS member_id,
               CASE WHEN CAST(e.timestamp AS DATE) > CAST(coalesce(m1.membership_start_dt, m2.membership_start_dt) AS DATE) + 1 THEN 'existing' ELSE 'new' END AS membership_state,
               coalesce(x.value IS NOT NULL OR y.value IS NOT NULL OR z.value IS NOT NULL OR e.email ILIKE '%corp.example.com%', FALSE) AS is_internal,
               coalesce(e.product_id, p.id) AS product_id_master, CASE WHEN lower(e.context_campaign_source) = 'facebook' AND f.campaign_id IS NOT NULL THEN f.campaign_id ELSE s.ad_campaign_id END AS campaign_id,
               i.region AS ip_region, i.country AS ip_country, i.city AS ip_city
        FROM o_sessioned e JOIN o_sessions s ON s.session_id = e.session_id LEFT JOIN o_touches t ON t.master_user_id = e.master_user_id LEFT JOIN o_visitors v ON v.master_user_id = e.master_user_id
        LEFT JOIN o_idmap d ON d.src = 'shopify' AND d.src_id = e.master_user_id LEFT JOIN o_members m1 ON m1.member_id = d.member_id LEFT JOIN o_members m2 ON m2.member_id = e.master_user_id
        LEFT JOIN b_exclusions x ON x.kind = 'context_ip' AND x.value = e.context_ip LEFT JOIN b_exclusions y ON y.kind = 'email' AND y.value = e.email
        LEFT JOIN b_exclusions z ON z.kind = 'anonymous_id' AND z.value = e.anonymous_id
        LEFT JOIN b_products p ON lower(trim(p.handle)) = lower(trim(CASE WHEN regexp_replace(regexp_replace(e.url, '.*products/', ''), '\\?.*', '') LIKE '%/%' THEN NULL
                                          ELSE regexp_replace(regexp_replace(e.url, '.*products/', ''), '\\?.*', '') END))
        LEFT JOIN o_campaigns f ON f.src_campaign_id = e.context_campaign_name AND f.channel_id = 'facebook_ads' LEFT JOIN b_geo i ON i.ip_id = e.context_ip""",
}

_ATTRIBUTED = """
    WITH touch AS (SELECT DISTINCT session_id, member_id, session_start_ts, session_channel_id, session_campaign_name FROM o_web),
    win AS (SELECT m.member_id, m.membership_start_dt AS order_ts, session_channel_id, session_campaign_name, row_number() OVER (PARTITION BY m.member_id ORDER BY session_start_ts, session_id) AS ra,
        row_number() OVER (PARTITION BY m.member_id ORDER BY session_start_ts DESC, session_id DESC) AS rd, count(*) OVER (PARTITION BY m.member_id) AS n
        FROM o_members m LEFT JOIN touch t ON t.member_id = m.member_id AND m.membership_start_dt + INTERVAL 24 HOUR >= session_start_ts AND m.membership_start_dt - INTERVAL 4320 HOUR <= session_start_ts
        WHERE m.membership_start_dt <= {0})
    SELECT member_id, order_ts, coalesce(session_channel_id, 'direct') AS channel_id, coalesce(session_campaign_name, 'no campaign') AS campaign_id, CASE WHEN ra = 1 THEN 1.0 ELSE 0 END AS first_touch_weighting,
        CASE WHEN rd = 1 THEN 1.0 ELSE 0 END AS last_touch_weighting, CASE WHEN n = 1 THEN 1.0 WHEN n = 2 THEN 0.5 WHEN ra = 1 OR rd = 1 THEN 0.25 ELSE 0.5 / (n - 2.0) END AS multi_touch_weighting FROM win"""
ORACLE["o_attributed"] = _ATTRIBUTED.format(AS_OF)


def oracle(sql: str) -> str:
    """`sql` with all the sources and entries it uses defined before it."""
    named = {**BINDINGS, **ORACLE}
    parts = [f"{n} AS ({named[n]})" for n in chain(sql, named)]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql
