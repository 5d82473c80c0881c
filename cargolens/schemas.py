"""Table schemas and the fixed values of the shipment model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- table schemas -------------------------------------------------------

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("street_number", T.LongType()),
    T.StructField("street_name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("postcode", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("registered_date", T.StringType()),
    T.StructField("nationality", T.StringType()),
])

WAREHOUSES = T.StructType([
    T.StructField("warehouse_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("capacity", T.LongType()),
])

WEATHER = T.StructType([
    T.StructField("warehouse_id", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("wind_speed", T.DoubleType()),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("warehouse_id", T.StringType()),
    T.StructField("package_weight_kg", T.DoubleType()),
    T.StructField("package_size", T.StringType()),
    T.StructField("priority", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

ROUTES = T.StructType([
    T.StructField("route_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("warehouse_id", T.StringType()),
    T.StructField("distance_km", T.DoubleType()),
    T.StructField("estimated_hours", T.DoubleType()),
    T.StructField("transport_mode", T.StringType()),
])

DELIVERY_RISK = T.StructType([
    T.StructField("route_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("warehouse_id", T.StringType()),
    T.StructField("distance_km", T.DoubleType()),
    T.StructField("estimated_hours", T.DoubleType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("wind_speed", T.DoubleType()),
    T.StructField("risk_score", T.IntegerType()),
    T.StructField("risk_level", T.StringType()),
])

STG_CUSTOMERS = ["customer_id", "first_name", "last_name", "email", "city",
                 "state", "country", "latitude", "longitude"]

STG_ORDERS = ["order_id", "customer_id", "warehouse_id", "package_weight_kg",
              "package_size", "priority", "status", "created_at"]

# Columns without which no job starts; the others of a schema may be absent.
REQUIRED = {
    "customers": STG_CUSTOMERS,
    "warehouses": WAREHOUSES.fieldNames(),
    "weather": WEATHER.fieldNames(),
    "orders": STG_ORDERS,
}

# --- fixed values --------------------------------------------------------
# Result-defining constants; they must be exactly these for right results.

EARTH_RADIUS_KM = 6371.0

# lower bound in km (inclusive) -> transport mode
MODE_TIERS = [(0.0, "van"), (500.0, "truck"), (3000.0, "air")]

# transport mode -> (km per hour, fixed handling hours)
MODE_PACE = {"van": (70.0, 1.0), "truck": (55.0, 2.0), "air": (800.0, 12.0)}

# lower bound (exclusive) -> points
DISTANCE_POINTS = [(2000, 15), (5000, 25), (10000, 35)]
DURATION_POINTS = [(12, 5), (24, 15), (36, 25)]
TEMPERATURE_POINTS = [(20, 10), (25, 20)]
WIND_POINTS = [(5, 5), (10, 15)]
MISSING_WEATHER_POINTS = 15
SCORE_CAP = 100

# lower bound of the score (inclusive) -> level, in order of severity
RISK_LEVELS = [(0, "LOW"), (25, "MEDIUM"), (50, "HIGH"), (65, "CRITICAL")]
HIGH_RISK = ["HIGH", "CRITICAL"]

STATUSES = ["created", "processing", "shipped", "delivered", "cancelled"]
PRIORITIES = ["standard", "express", "priority"]
PACKAGE_SIZES = ["small", "medium", "large"]
