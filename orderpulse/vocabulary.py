"""Fixed values of the model: names, orders and thresholds that results depend on."""

# Event types of the contract, in lifecycle order.
EVENT_TYPES = (
    "order_placed",
    "order_confirmed",
    "order_prepared",
    "order_picked_up",
    "order_delivered",
    "order_cancelled",
)

# Order fact column -> event type whose time it holds.
STAGE_EVENTS = {
    "placed_at": "order_placed",
    "confirmed_at": "order_confirmed",
    "prepared_at": "order_prepared",
    "picked_up_at": "order_picked_up",
    "delivered_at": "order_delivered",
    "cancelled_at": "order_cancelled",
}

# Final status by the first stage reached in this order; none reached means "unknown".
STATUS_BY_STAGE = {
    "delivered_at": "delivered",
    "cancelled_at": "cancelled",
    "picked_up_at": "in_transit",
    "prepared_at": "prepared",
    "confirmed_at": "confirmed",
    "placed_at": "placed",
}
IN_PROGRESS = ("placed", "confirmed", "prepared", "in_transit")

# Event type -> types that may follow it; an order starts with order_placed.
FIRST_EVENT = "order_placed"
NEXT_EVENTS = {
    "order_placed": ("order_confirmed", "order_cancelled"),
    "order_confirmed": ("order_prepared", "order_cancelled"),
    "order_prepared": ("order_picked_up", "order_cancelled"),
    "order_picked_up": ("order_delivered",),
}

# Keys and measures of the order fact.
ORDER_KEYS = ("customer_id", "vendor_id", "driver_id")
PLACED_MEASURES = ("gmv", "food_cost", "delivery_fee", "service_fee", "discount")
CANCEL_CONTEXT = ("cancelled_by", "cancel_reason")

# Cancelling actors in display order; everyone else is "other".
CANCEL_ACTORS = ("customer", "vendor", "driver", "system")
OTHER_ACTOR = "other"

# dayofweek() code -> label, 1 is Sunday.
WEEKDAYS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")

# Presets offered by the serving queries.
RANGE_DAYS = {"7d": 7, "30d": 30, "90d": 90, "All": None}
WINDOW_HOURS = {"24h": 24, "48h": 48, "72h": 72, "7d": 168, "14d": 336}

# Monitoring thresholds.
LIVE_MINUTES = 10_080
OUTAGE_MINUTES = 5_760
STALE_HOURS = 3
BACKFILL_HOURS = 168
BASELINE_DAYS = 7

# Streaming.
WATERMARK = "1 hour"

# Layers in flow order, and why each may hold fewer rows than the one before.
LAYERS = {
    "bronze": "every row as delivered",
    "silver": "repeated event ids and rows behind the watermark are removed",
    "gold": "modelled from silver, expected to match it",
}

# Tables of the gold layer.
GOLD_TABLES = (
    "dim_customer",
    "dim_vendor",
    "dim_driver",
    "dim_menu_item",
    "fct_orders",
    "fct_order_items",
    "fct_order_events",
    "fct_daily_metrics",
)
