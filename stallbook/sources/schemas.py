"""Canonical input schemas (fixed values)."""

from __future__ import annotations

SUPPLIERS = "supplier_id int, name string, city string, rating string, lead_time_days int, on_time_rate decimal(5,2)"

PRODUCTS = (
    "product_id int, sku string, brand string, name string, category string, cost_price decimal(10,2), "
    "selling_price decimal(10,2), stock_quantity int, reorder_point int, supplier_id int"
)

USERS = (
    "user_id int, name string, email string, phone string, city string, signup_date timestamp, "
    "member_level string, total_points int"
)

ORDERS = (
    "order_id int, user_id int, order_date timestamp, status string, payment_method string, "
    "shipping_fee decimal(8,2), discount_amount decimal(8,2)"
)

ORDER_ITEMS = "item_id int, order_id int, product_id int, quantity int, unit_price decimal(10,2)"

RETURNS = (
    "return_id int, order_id int, product_id int, return_date timestamp, reason string, "
    "refund_amount decimal(10,2), status string"
)

PURCHASE_ORDERS = (
    "po_id int, supplier_id int, product_id int, quantity int, unit_cost decimal(10,2), order_date timestamp, "
    "expected_date timestamp, received_date timestamp, status string"
)

CLICKS = (
    "event_id string, user_id int, event_type string, timestamp string, device string, os string, referrer string, "
    "metadata struct<product_id_viewed:int,search_query:string,session_duration_sec:int,page_depth:int>"
)

CLICKS_FLAT = (
    "event_id string, user_id int, event_type string, timestamp string, device string, "
    "metadata struct<url:string,session_duration_sec:int>"
)

CLICKS_LIVE = (
    "event_id string, user_id int, event_type string, timestamp string, device string, os string, referrer string, "
    "metadata struct<product_id:int,category:string,price:int,session_duration_sec:int,page_depth:int>"
)

TICKETS = (
    "ticket_id string, user_id int, type string, priority string, status string, created_at string, "
    "resolved_at string, satisfaction_score int"
)
