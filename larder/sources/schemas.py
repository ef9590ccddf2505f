"""Declared table schemas, keys, references and value domains."""

from __future__ import annotations

from pyspark.sql.types import StructType

# fixed values: column names and types of the twelve tables
TABLES: dict[str, str] = {
    "Customers": "customer_id bigint not null, registration_date date",
    "Restaurants": "restaurant_id bigint not null, restaurant_name string, city string",
    "Menu_Categories": "category_id bigint not null, category_name string",
    "Menu_Items": (
        "menu_item_id bigint not null, category_id bigint not null, item_name string, description string, "
        "base_price decimal(10,2), standard_cost decimal(10,2), availability boolean, "
        "unit_of_measure string, launch_date date"
    ),
    "Pricing_History": (
        "pricing_history_id bigint not null, menu_item_id bigint not null, effective_date date, "
        "unit_price decimal(10,2)"
    ),
    "Promotions": (
        "promotion_id bigint not null, promotion_name string, discount_type string, "
        "discount_value decimal(10,2), coupon_code string, start_date date, end_date date"
    ),
    "Promotion_Items": "promotion_id bigint not null, menu_item_id bigint not null",
    "Orders": (
        "order_id bigint not null, customer_id bigint, restaurant_id bigint, promotion_id bigint, "
        "order_timestamp timestamp, order_channel string, order_status string, subtotal decimal(12,2), "
        "discount_total decimal(12,2), total_amount decimal(12,2)"
    ),
    "Order_Items": (
        "order_item_id bigint not null, order_id bigint, menu_item_id bigint, quantity decimal(10,2), "
        "unit_price decimal(10,2), unit_cost decimal(10,2), discount_amount decimal(12,2), "
        "line_total decimal(12,2)"
    ),
    "Ratings": (
        "rating_id bigint not null, customer_id bigint, menu_item_id bigint, restaurant_id bigint, "
        "rating_value int, rating_timestamp timestamp"
    ),
    "Inventory": (
        "inventory_id bigint not null, menu_item_id bigint not null, restaurant_id bigint not null, "
        "inventory_date date, opening_quantity decimal(12,3), replenishment_quantity decimal(12,3), "
        "consumption_quantity decimal(12,3), closing_quantity decimal(12,3), unit_of_measure string"
    ),
    "Wastage": (
        "wastage_id bigint not null, menu_item_id bigint not null, restaurant_id bigint not null, "
        "wastage_date date, quantity_wasted decimal(12,3), unit_of_measure string, "
        "wastage_cost decimal(10,2), wastage_reason string"
    ),
}

# fixed values: keys of the tables
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "Customers": ("customer_id",),
    "Restaurants": ("restaurant_id",),
    "Menu_Categories": ("category_id",),
    "Menu_Items": ("menu_item_id",),
    "Pricing_History": ("pricing_history_id",),
    "Promotions": ("promotion_id",),
    "Promotion_Items": ("promotion_id", "menu_item_id"),
    "Orders": ("order_id",),
    "Order_Items": ("order_item_id",),
    "Ratings": ("rating_id",),
    "Inventory": ("inventory_id",),
    "Wastage": ("wastage_id",),
}

# (child table, child column, parent table, parent column, tolerated orphan share)
# fixed values: references between the tables
FOREIGN_KEYS: list[tuple[str, str, str, str, float]] = [
    ("Menu_Items", "category_id", "Menu_Categories", "category_id", 0.0),
    ("Pricing_History", "menu_item_id", "Menu_Items", "menu_item_id", 0.0),
    ("Promotion_Items", "promotion_id", "Promotions", "promotion_id", 0.0),
    ("Promotion_Items", "menu_item_id", "Menu_Items", "menu_item_id", 0.0),
    ("Orders", "customer_id", "Customers", "customer_id", 0.01),
    ("Orders", "restaurant_id", "Restaurants", "restaurant_id", 0.01),
    ("Orders", "promotion_id", "Promotions", "promotion_id", 0.01),
    ("Order_Items", "order_id", "Orders", "order_id", 0.01),
    ("Order_Items", "menu_item_id", "Menu_Items", "menu_item_id", 0.01),
    ("Ratings", "menu_item_id", "Menu_Items", "menu_item_id", 0.01),
    ("Inventory", "restaurant_id", "Restaurants", "restaurant_id", 0.01),
    ("Wastage", "restaurant_id", "Restaurants", "restaurant_id", 0.01),
]

# fixed values: columns that must be known
CRITICAL_COLUMNS: dict[str, tuple[str, ...]] = {
    "Customers": ("customer_id",),
    "Orders": ("order_id", "customer_id"),
    "Order_Items": ("order_item_id", "order_id"),
    "Menu_Items": ("menu_item_id", "category_id"),
    "Menu_Categories": ("category_id",),
    "Restaurants": ("restaurant_id",),
    "Ratings": ("rating_id", "rating_value"),
    "Wastage": ("wastage_id",),
}

# fixed values: least rows of a table
MIN_ROWS: dict[str, int] = {
    "Customers": 50_000,
    "Orders": 100_000,
    "Order_Items": 1_000_000,
    "Menu_Items": 150,
    "Menu_Categories": 10,
    "Restaurants": 20,
    "Ratings": 100_000,
    "Wastage": 50_000,
}

# fixed values: units of measure
VALID_UNITS = ("portion", "plate", "bowl", "glass", "piece")


def schema(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])
