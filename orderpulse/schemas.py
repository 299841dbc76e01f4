"""Explicit schemas, so that no production read infers types by scanning its input."""

ITEM = (
    "struct<menu_item_id: string, name: string, quantity: bigint, "
    "unit_price: bigint, line_total: bigint>"
)

PAYLOAD = (
    f"struct<items: array<{ITEM}>, delivery_address: string, food_cost: bigint, "
    "delivery_fee: bigint, service_fee: bigint, discount: bigint, gmv: bigint, "
    "estimated_prep_minutes: bigint, driver_id: string, vehicle_type: string, "
    "cancelled_by: string, reason: string>"
)

_EVENT_HEAD = (
    "event_id string, event_type string, order_id string, occurred_at string, "
    "customer_id string, vendor_id string, driver_id string"
)

# Raw event with the payload as the union of all shapes; absent keys read as NULL.
RAW_EVENT = f"{_EVENT_HEAD}, payload {PAYLOAD}"

# Raw event whose payload arrives as JSON text.
RAW_EVENT_TEXT = f"{_EVENT_HEAD}, payload string"

# Flat seed events, without items.
SEED_EVENT = (
    "event_id string, event_type string, order_id string, occurred_at timestamp, "
    "customer_id string, vendor_id string, driver_id string, gmv bigint, food_cost bigint, "
    "delivery_fee bigint, service_fee bigint, discount bigint, cancelled_by string, "
    "cancel_reason string"
)

DIMENSIONS = {
    "customers": (
        "customer_id string, name string, email string, phone string, city string, "
        "lat double, lon double, registration_date date"
    ),
    "vendors": (
        "vendor_id string, name string, cuisine_type string, city string, lat double, "
        "lon double, avg_prep_minutes int, rating double"
    ),
    "drivers": "driver_id string, name string, vehicle_type string, city string, rating double",
    "menu_items": (
        "menu_item_id string, vendor_id string, name string, category string, price int, "
        "is_available boolean"
    ),
}
