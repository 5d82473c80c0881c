"""Shipment tables from TPC-H style order data.

Each view is one SELECT that is valid both in Spark SQL and (with double quotes for
backticks) in DuckDB, so a query and its SQL counterpart start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BASE = ("region", "nation", "customer", "supplier", "orders", "events")



def _padded(prefix: str, number: str) -> str:
    """SQL for `WH-007`: at least 3 digits, without a formatter call per row."""
    return (f"concat('{prefix}-', case when {number} < 10 then '00' when {number} < 100 then '0' "
            f"else '' end, cast({number} as string))")


CUSTOMERS = """
select concat('CUST-', cast(c_custkey as string)) customer_id, 'Customer' first_name,
       substring(c_name, 10) last_name,
       lower(concat('customer.', substring(c_name, 10), '@example.eu')) email,
       concat('CITY_', cast(c_custkey % 30 as string)) city, r_name state, n_name country,
       case when c_custkey % 50 = 0 then -35e0
            else 35e0 + ((c_custkey * 7919) % 3000) / 100e0 end latitude,
       case when c_custkey % 50 = 0 then 150e0
            else -10e0 + ((c_custkey * 104729) % 4000) / 100e0 end longitude
from {customer} join {nation} on c_nationkey = n_nationkey
     join {region} on r_regionkey = n_regionkey"""

WAREHOUSES = f"""
select {_padded('WH', 's_suppkey')} warehouse_id, s_name name,
       concat('CITY_', cast(s_suppkey % 30 as string)) city, n_name country,
       40e0 + ((s_suppkey * 631) % 1500) / 100e0 latitude,
       -5e0 + ((s_suppkey * 877) % 2500) / 100e0 longitude,
       45000 + cast(s_suppkey % 4 as int) * 10000 capacity
from {{supplier}} join {{nation}} on s_nationkey = n_nationkey"""

_CUSTOMER_ID = "concat('CUST-', cast(o_custkey as string))"
_ORDER_ID = "concat('ORD-', cast(o_orderkey as string))"
_STATUS = """case when o_orderstatus = 'F' and o_orderkey % 7 = 0 then 'cancelled'
            when o_orderstatus = 'F' then 'delivered' when o_orderstatus = 'P' then 'shipped'
            when o_orderkey % 2 = 0 then 'created' else 'processing' end"""


def _orders(order_id: str, customer_id: str, status: str, dated: str = "true") -> str:
    return f"""
select {order_id} order_id, {customer_id} customer_id,
       {_padded('WH', 'site')} warehouse_id,
       0.5e0 + (o_orderkey % 2450) / 100e0 package_weight_kg,
       case when o_orderkey % 3 = 0 then 'small' when o_orderkey % 3 = 1 then 'medium'
            else 'large' end package_size,
       case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'priority'
            when o_orderpriority = '3-MEDIUM' then 'express' else 'standard' end priority,
       {status} status,
       case when {dated} then (select min(ts) from {{events}})
           + interval '1' second * cast((o_orderkey * 173) % 2592000 as int) end created_at
from (select *, (o_orderkey * 31 + o_custkey) % (select count(*) from {{supplier}}) site
      from {{orders}})"""


ORDERS = _orders(_ORDER_ID, _CUSTOMER_ID, _STATUS)

WEATHER = f"""
select {_padded('WH', 'user_id')} warehouse_id, event_id, ts as `timestamp`,
       -5e0 + ((event_id * 37) % 4000) / 100e0 temperature,
       ((event_id * 53) % 2000) / 100e0 wind_speed
from {{events}} where user_id % 10 <> 3"""

# Dirty variants: orphan customers, null ids, unknown status, repeated orders.
_DIRTY_CUSTOMER = f"case when o_orderkey % 997 = 0 then 'CUST-MISSING' else {_CUSTOMER_ID} end"
_DIRTY_ID = f"case when o_orderkey % 991 = 0 then null else {_ORDER_ID} end"
_DIRTY_STATUS = f"case when o_orderkey % 983 = 0 then 'lost' else {_STATUS} end"
_ALL_DIRTY = _orders(_DIRTY_ID, _DIRTY_CUSTOMER, _DIRTY_STATUS)
ORDERS_DIRTY = f"""{_ALL_DIRTY}
union all {_ALL_DIRTY} where o_orderkey % 1499 = 0"""

ORDERS_ORPHANED = _orders(_ORDER_ID, _DIRTY_CUSTOMER, _STATUS)

# Every 7th order arrives a second time.
ORDERS_REPEATED = f"""{ORDERS}
union all {ORDERS} where o_orderkey % 7 = 0"""

# Every 7th order comes again an hour later, every 11th at the same time with another weight.
ORDERS_VERSIONS = f"""
select * from ({ORDERS})
union all select order_id, customer_id, warehouse_id, package_weight_kg, package_size, priority,
       'cancelled' status, created_at + interval '1' hour created_at
from ({ORDERS}) where cast(substring(order_id, 5) as bigint) % 7 = 0
union all select order_id, customer_id, warehouse_id, package_weight_kg + 1e0 package_weight_kg,
       package_size, priority, status, created_at
from ({ORDERS}) where cast(substring(order_id, 5) as bigint) % 11 = 0"""

# Every 11th order has no time; some have no id, and every 7th arrives a second time.
ORDERS_UNDATED = _orders(_ORDER_ID, _CUSTOMER_ID, _STATUS, "o_orderkey % 11 <> 0")
_UNNAMED = _orders(_DIRTY_ID, _CUSTOMER_ID, _STATUS)
ORDERS_UNNAMED = f"""{_UNNAMED}
union all {_UNNAMED} where o_orderkey % 7 = 0"""

# All customer fields as text; some coordinates do not parse or are missing.
RAW_CUSTOMERS = """
select concat('CUST-', cast(c_custkey as string)) customer_id,
       case when c_custkey % 2 = 0 then 'Mr' else 'Ms' end title, 'Customer' first_name,
       substring(c_name, 10) last_name,
       case when c_custkey % 2 = 0 then 'male' else 'female' end gender,
       lower(concat('customer.', substring(c_name, 10), '@example.eu')) email,
       concat('+', cast(30 + c_custkey % 20 as string), '-', cast(c_custkey as string)) phone,
       cast(1 + c_custkey % 250 as string) street_number, 'Main Street' street_name,
       concat('CITY_', cast(c_custkey % 30 as string)) city, r_name state, n_name country,
       cast(1000 + c_custkey % 9000 as string) postcode,
       case when c_custkey % 97 = 0 then 'abc' when c_custkey % 89 = 0 then null
            else cast(35e0 + ((c_custkey * 7919) % 3000) / 100e0 as string) end latitude,
       case when c_custkey % 89 = 0 then null
            else cast(-10e0 + ((c_custkey * 104729) % 4000) / 100e0 as string) end longitude,
       '2020-01-01T00:00:00' registered_date, upper(substring(n_name, 1, 2)) nationality
from {customer} join {nation} on c_nationkey = n_nationkey
     join {region} on r_regionkey = n_regionkey"""

# JSON records whose fields hold values of various JSON types.
TYPED_RECORDS = """
select concat('{{"customer_id": "CUST-', cast(c_custkey as string),
       '", "title": "Ms", "last_name": "L", "gender": "female", "phone": "1", "street_name": "S", ',
       '"city": "C", "state": "S", "country": "C", "postcode": "1", "longitude": 4.5, ',
       '"registered_date": "2020-01-01", "nationality": "NL", "first_name": ',
       case c_custkey % 11 when 1 then '5' when 2 then '[1]' when 3 then '{{"a": 1}}' else '"Ann"' end,
       ', "street_number": ',
       case c_custkey % 11 when 4 then '42.0' when 5 then '" 42 "' when 7 then 'true' when 8 then '42.5'
            else cast(c_custkey % 250 as string) end,
       ', "latitude": ',
       case c_custkey % 11 when 6 then '"52.3676"' when 9 then '"abc"' when 10 then '7' else '35.25' end,
       case c_custkey % 11 when 0 then ', "email": null' when 10 then '' else ', "email": "a@b"' end,
       '}}') document
from {customer}"""

# The address a customer gave with each order: versions of the customer.
CUSTOMER_VERSIONS = """
select concat('CUST-', cast(o_custkey as string)) customer_id, o_orderkey version_id,
       concat('CITY_', cast(o_orderkey % 30 as string)) city, o_orderdate changed_at
from {orders}"""

# Weather with time stamps cut to the hour, so that observations tie.
WEATHER_TIED = WEATHER.replace("ts as `timestamp`", "date_trunc('hour', ts) as `timestamp`")

VIEWS = {
    "customers": CUSTOMERS, "warehouses": WAREHOUSES, "ship_orders": ORDERS, "weather": WEATHER,
    "weather_tied": WEATHER_TIED, "orders_dirty": ORDERS_DIRTY,
    "orders_orphaned": ORDERS_ORPHANED, "orders_repeated": ORDERS_REPEATED,
    "orders_undated": ORDERS_UNDATED, "orders_unnamed": ORDERS_UNNAMED,
    "orders_versions": ORDERS_VERSIONS,
    "raw_customers": RAW_CUSTOMERS, "typed_records": TYPED_RECORDS, "customer_versions": CUSTOMER_VERSIONS,
}


# (application, path) -> schema, so that file footers are read once and not per query
_SCHEMAS: dict[tuple, StructType] = {}


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.conf.get("spark.app.id"), path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def view(spark: SparkSession, sf_dir: str, name: str, **replaced: DataFrame) -> DataFrame:
    """One of `VIEWS` over the tables in `sf_dir`, or over the frames in `replaced`."""
    text = VIEWS[name]
    tables = {t: replaced[t] if t in replaced else base_table(spark, sf_dir, t)
              for t in BASE if f"{{{t}}}" in text}
    return spark.sql(text, **tables)


def sql_views() -> str:
    """The views as the leading CTEs of a DuckDB query."""
    names = {t: t for t in BASE}
    parts = [f"{name} as ({text.format(**names).replace('`', chr(34))})"
             for name, text in VIEWS.items()]
    return "with " + ",\n".join(parts)
