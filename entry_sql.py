"""SQL counterparts of the registered queries, for DuckDB.

Averages and ratios are rounded to 4 decimals. Their last digits depend on the order of
summation, which would tip an exact tie (138.74 / 16 = 8.67125) either way, so both sides
add 1e-9 first.
"""

from __future__ import annotations

from cargolens import testbed
from cargolens.sources import reference

SOME_FILTERS = {
    "warehouses": [f"Supplier#{n:09d}" for n in range(1, 41)],
    "statuses": ["created", "shipped", "delivered"],
    "priorities": ["priority", "standard"],
    "risk": ["MEDIUM", "HIGH"],
}
NO_MATCH = {"warehouses": ["O'Brien's depot"], "statuses": ["shipped"]}

ROUTES = """
select concat('RT-', order_id) route_id, order_id, customer_id, warehouse_id,
       round(km, 2) distance_km,
       round(case mode when 'van' then km / 70e0 + 1e0 when 'truck' then km / 55e0 + 2e0
             else km / 800e0 + 12e0 end, 2) estimated_hours,
       mode transport_mode
from (select *, case when km >= 3000e0 then 'air' when km >= 500e0 then 'truck' else 'van' end mode
      from (select order_id, customer_id, warehouse_id,
                   2e0 * 6371e0 * atan2(sqrt(a), sqrt(greatest(1e0 - a, 0e0))) km
            from (select o.order_id, o.customer_id, o.warehouse_id,
                         pow(sin((radians(c.latitude) - radians(w.latitude)) / 2), 2)
                         + cos(radians(w.latitude)) * cos(radians(c.latitude))
                         * pow(sin((radians(c.longitude) - radians(w.longitude)) / 2), 2) a
                  from {orders} o join customers c on o.customer_id = c.customer_id
                       join warehouses w on o.warehouse_id = w.warehouse_id)))"""

LATEST = """
select warehouse_id, temperature, wind_speed
from (select *, row_number() over (partition by warehouse_id
             order by "timestamp" desc nulls last, event_id desc) rn from {weather})
where rn = 1"""

RISK = """
select *, case when risk_score >= 65 then 'CRITICAL' when risk_score >= 50 then 'HIGH'
               when risk_score >= 25 then 'MEDIUM' else 'LOW' end risk_level
from (select r.route_id, r.order_id, r.warehouse_id, r.distance_km, r.estimated_hours,
             l.temperature, l.wind_speed,
             cast(least(
               case when distance_km > 10000 then 35 when distance_km > 5000 then 25
                    when distance_km > 2000 then 15 else 0 end
               + case when estimated_hours > 36 then 25 when estimated_hours > 24 then 15
                      when estimated_hours > 12 then 5 else 0 end
               + case when temperature is null then {missing} when temperature > 25 then 20
                      when temperature > 20 then 10 else 0 end
               + case when wind_speed is null then {missing} when wind_speed > 10 then 15
                      when wind_speed > 5 then 5 else 0 end, 100) as integer) risk_score
      from {routes} r left join latest l on r.warehouse_id = l.warehouse_id)"""

FACT = """
select o.order_id, o.customer_id, o.warehouse_id, o.created_at order_date, o.package_weight_kg,
       o.package_size, o.priority, o.status, c.city customer_city, c.country customer_country
from {orders} o left join customers c on o.customer_id = c.customer_id"""

PERFORMANCE = """
select f.order_id, f.customer_id, f.warehouse_id, f.order_date, f.status, f.package_weight_kg,
       f.package_size, f.priority, f.customer_city, f.customer_country, r.route_id, r.distance_km,
       r.estimated_hours estimated_delivery_hours, r.transport_mode, d.temperature, d.wind_speed,
       d.risk_score, d.risk_level risk_category
from {fact} f left join {routes} r on f.order_id = r.order_id
     left join {risk} d on f.order_id = d.order_id"""


# Customers after the second landing; the weather that landed last, ties by the measured values.
_LANDED = """select * replace (
         case when n % 5 = 0 then 'CITY_NEW' else city end as city,
         case when n % 97 = 0 then 10.5e0 else try_cast(latitude as double) end as latitude,
         try_cast(longitude as double) as longitude)
  from (select *, cast(substring(customer_id, 6) as bigint) n from raw_customers)
  where (n % 97 = 0 or try_cast(latitude as double) is not null)
        and try_cast(longitude as double) is not null"""
_LANDED_WEATHER = """select warehouse_id, temperature, wind_speed from (
  select *, row_number() over (partition by warehouse_id
            order by "timestamp" desc, temperature desc, wind_speed desc) rn from weather) where rn = 1"""


def _landed() -> str:
    routes = ROUTES.format(orders="ship_orders").replace("join customers c", f"join ({_LANDED}) c")
    risk = RISK.format(missing=0, routes=f"({routes})").replace("join latest l", f"join ({_LANDED_WEATHER}) l")
    fact = FACT.format(orders="ship_orders").replace("join customers c", f"join ({_LANDED}) c")
    return PERFORMANCE.format(fact=f"({fact})", routes=f"({routes})", risk=f"({risk})")


def _reference_routes() -> str:
    towns = ", ".join(f"({k}, {row[3]}e0, {row[4]}e0)" for k, row in enumerate(reference.CITIES))
    depots = ", ".join(f"('WH-00{k}', {row[3]}e0, {row[4]}e0)" for k, row in enumerate(reference.WAREHOUSES, 1))
    people = f"""(select customer_id, t.latitude, t.longitude
       from customers join (values {towns}) t(n, latitude, longitude)
            on cast(substring(customer_id, 6) as bigint) % {len(reference.CITIES)} = t.n)"""
    orders = """(select * replace ('WH-00' || (cast(substring(order_id, 5) as bigint) % 4 + 1) as warehouse_id)
       from ship_orders)"""
    return (ROUTES.format(orders=orders).replace("join customers c", f"join {people} c")
            .replace("join warehouses w", f"join (values {depots}) w(warehouse_id, latitude, longitude)"))


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _where(chosen: dict, alias: str = "") -> str:
    column = {"statuses": "status", "priorities": "priority", "risk": "risk_category"}
    terms = [f"{alias}{column[k]} in ({_quoted(v)})" for k, v in chosen.items() if k in column]
    if chosen.get("warehouses"):
        terms.append(f"{alias}warehouse_id in (select warehouse_id from warehouses "
                     f"where name in ({_quoted(chosen['warehouses'])}))")
    return "where " + " and ".join(terms)


def _tables(suffix: str = "", orders: str = "ship_orders", missing: int = 0) -> str:
    """CTEs routes, risk, fact and dp (with a suffix) over a view of orders."""
    names = {n: n + suffix for n in ("routes", "risk", "fact", "dp")}
    return f""",
{names['routes']} as ({ROUTES.format(orders=orders)}),
{names['risk']} as ({RISK.format(missing=missing, routes=names['routes'])}),
{names['fact']} as ({FACT.format(orders=orders)}),
{names['dp']} as ({PERFORMANCE.format(**names)})"""


# Every declared test of the three marts: table, column, check, SQL that counts what fails.
_MART_TESTS = """
dim_customers | customer_id | unique | select count(*) from (select customer_id from {dim} where customer_id is not null group by 1 having count(*) > 1)
dim_customers | customer_id | not_null | select count(*) from {dim} where customer_id is null
dim_customers | country | not_null | select count(*) from {dim} where country is null
fact_shipments | order_id | unique | select count(*) from (select order_id from {fact} where order_id is not null group by 1 having count(*) > 1)
fact_shipments | order_id | not_null | select count(*) from {fact} where order_id is null
fact_shipments | customer_id | not_null | select count(*) from {fact} where customer_id is null
fact_shipments | warehouse_id | not_null | select count(*) from {fact} where warehouse_id is null
fact_shipments | order_date | not_null | select count(*) from {fact} where order_date is null
fact_shipments | customer_id | relationships | select count(*) from {fact} where customer_id not in (select customer_id from {dim})
fact_shipments | status | accepted_values | select count(*) from {fact} where status not in ('created', 'processing', 'shipped', 'delivered', 'cancelled')
delivery_performance | order_id | unique | select count(*) from (select order_id from {dp} where order_id is not null group by 1 having count(*) > 1)
delivery_performance | order_id | not_null | select count(*) from {dp} where order_id is null
delivery_performance | customer_id | not_null | select count(*) from {dp} where customer_id is null
delivery_performance | warehouse_id | not_null | select count(*) from {dp} where warehouse_id is null
delivery_performance | risk_score | not_null | select count(*) from {dp} where risk_score is null
delivery_performance | transport_mode | accepted_values | select count(*) from {dp} where transport_mode not in ('van', 'truck', 'air')
delivery_performance | risk_category | accepted_values | select count(*) from {dp} where risk_category not in ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')
"""

# Ranges, source value sets, key inclusion and row counts.
_RANGE_TESTS = """
customers | latitude | in_range | select count(*) from customers where latitude < 35 or latitude > 70
customers | longitude | in_range | select count(*) from customers where longitude < -10 or longitude > 30
orders | package_weight_kg | in_range | select count(*) from ship_orders where package_weight_kg <= 0 or package_weight_kg > 30
orders | priority | accepted_values | select count(*) from ship_orders where priority not in ('standard', 'express', 'priority')
orders | package_size | accepted_values | select count(*) from ship_orders where package_size not in ('small', 'medium', 'large')
orders | status | accepted_values | select count(*) from ship_orders where status not in ('created', 'processing', 'shipped', 'delivered', 'cancelled')
orders | customer_id | relationships | select count(*) from ship_orders where customer_id not in (select customer_id from customers)
orders | warehouse_id | relationships | select count(*) from ship_orders where warehouse_id not in (select warehouse_id from warehouses)
delivery_performance | risk_score | in_range | select count(*) from dp where risk_score < 0 or risk_score > 100
delivery_performance | distance_km | in_range | select count(*) from dp where distance_km < 0
delivery_performance | estimated_delivery_hours | in_range | select count(*) from dp where estimated_delivery_hours <= 0
delivery_performance | | same_rows | select abs((select count(*) from dp) - (select count(*) from ship_orders))
"""


def _tests_sql(tests: str, **tables: str) -> str:
    parts = []
    for line in tests.strip().splitlines():
        table, column, kind, count = (part.strip() for part in line.split("|"))
        name = f"'{column}'" if column else "cast(null as varchar)"
        parts.append(f"select '{table}' table_name, {name} column_name, '{kind}' check_name, "
                     f"n failing_rows, n = 0 passed from (select ({count.format(**tables)}) n)")
    return " union all ".join(parts)


_ASOF = """select o.order_id, o.warehouse_id, o.created_at, w.temperature, w.wind_speed
from ship_orders o asof left join (
  select * from (select *, row_number() over (partition by warehouse_id, "timestamp"
         order by event_id desc) rn from weather) where rn = 1) w
on o.warehouse_id = w.warehouse_id and o.created_at >= w."timestamp" """

# Routes of the dirty orders that keep their time.
_DATED_ROUTES = (ROUTES.format(orders="orders_dirty")
                 .replace("concat('RT-', order_id)", "'RT-' || order_id")
                 .replace("order_id, customer_id, warehouse_id", "order_id, customer_id, warehouse_id, created_at")
                 .replace("o.order_id, o.customer_id, o.warehouse_id,", "o.order_id, o.customer_id, o.warehouse_id, o.created_at,"))

_RAW_OK = """select customer_id, title, first_name, last_name, gender, email, phone,
       cast(street_number as bigint) street_number, street_name, city, state, country, postcode,
       try_cast(latitude as double) latitude,
       try_cast(longitude as double) longitude, registered_date, nationality
from raw_customers where try_cast(latitude as double) is not null
     and try_cast(longitude as double) is not null"""

_DP_ROWS = "select * from {}"

_WAREHOUSE = """select w.name, w.city, w.country, w.capacity, count(d.order_id) shipments,
       round(avg(d.distance_km) + 1e-9, 4) avg_distance,
       round(avg(d.estimated_delivery_hours) + 1e-9, 4) avg_delivery_hours,
       round(avg(d.risk_score) + 1e-9, 4) avg_risk
from warehouses w left join {dp} d on w.warehouse_id = d.warehouse_id {where}
group by w.name, w.city, w.country, w.capacity"""

_CAPACITY = """select *, round(case when max(shipments) over () = 0 then 0e0
       else shipments / max(shipments) over () * 100e0 end + 1e-9, 4)
       utilisation_idx
from (select w.name, w.city, w.country, w.capacity, count(d.order_id) shipments
      from warehouses w left join {dp} d on w.warehouse_id = d.warehouse_id {where}
      group by w.name, w.city, w.country, w.capacity)"""


def _histogram(column: str, bins: int, where: str) -> str:
    return f"""select bin, count(*) n from (
  select least(coalesce(cast(floor((v - lo) / nullif((hi - lo) / {bins}e0, 0)) as integer),
                        0), {bins - 1}) bin
  from (select {column} v, min({column}) over () lo, max({column}) over () hi from dp {where})
  where v is not null)
group by bin"""


def _reports(where: str = "", on_d: str = "") -> dict[str, str]:
    """The filterable reports; `on_d` is the same filter for a mart called `d`."""
    def by(column: str) -> str:
        return f"select {column}, count(*) shipments from dp {where} group by {column}"

    averages = """round(avg(distance_km) + 1e-9, 4) avg_distance, {hours}
            round(avg(risk_score) + 1e-9, 4) avg_risk"""
    return {
        "overview_metrics": f"""select count(*) shipments, count(distinct customer_id) customers,
            count(distinct warehouse_id) warehouses,
            {averages.format(hours='round(avg(estimated_delivery_hours) + 1e-9, 4) avg_delivery,')},
            round(avg(package_weight_kg) + 1e-9, 4) avg_weight,
            count(*) filter (where risk_category in ('HIGH', 'CRITICAL')) high_risk_shipments
            from dp {where}""",
        "shipment_status": by("status"),
        "priority_distribution": by("priority"),
        "shipment_timeline": f"""select cast(order_date as date) "date", count(*) shipments
            from dp {where} group by 1""",
        "risk_summary": by("risk_category"),
        "package_sizes": by("package_size"),
        "warehouse_performance": _WAREHOUSE.format(dp="dp", where=on_d),
        "warehouse_metrics": f"""select count(distinct warehouse_id) warehouses,
            count(order_id) shipments, {averages.format(hours='')} from dp {where}""",
        "capacity_index": _CAPACITY.format(dp="dp", where=on_d),
        "top_customers": f"""select d.customer_id, c.first_name || ' ' || c.last_name customer,
            c.country, count(d.order_id) shipments, round(avg(d.package_weight_kg) + 1e-9, 4) avg_weight
            from dp d join customers c on d.customer_id = c.customer_id {on_d}
            group by all order by shipments desc, d.customer_id limit 20""",
        "customer_metrics": f"""select count(distinct customer_id) customers,
            count(order_id) shipments, round(avg(package_weight_kg) + 1e-9, 4) avg_weight
            from dp {where}""",
        "shipments_by_country": by("customer_country")
            + " order by shipments desc, customer_country limit 15",
        "package_behaviour": f"""select package_size, count(*) shipments,
            round(avg(package_weight_kg) + 1e-9, 4) avg_weight from dp {where} group by package_size""",
        "customer_locations": f"""select distinct d.customer_id, c.first_name, c.last_name, c.city,
            c.country, c.latitude, c.longitude
            from dp d join customers c on d.customer_id = c.customer_id {on_d}""",
        "risk_metrics": f"""select count(*) shipments, round(avg(risk_score) + 1e-9, 4) avg_risk,
            max(risk_score) max_risk,
            count(*) filter (where risk_category in ('HIGH', 'CRITICAL')) high_risk_count
            from dp {where}""",
        "risk_by_warehouse": f"""select w.warehouse_id, w.name, count(d.order_id) shipments,
            round(avg(d.risk_score) + 1e-9, 4) avg_risk
            from dp d join warehouses w on d.warehouse_id = w.warehouse_id {on_d}
            group by w.warehouse_id, w.name""",
        "highest_risk": f"""select route_id, order_id, warehouse_id, transport_mode, distance_km,
            estimated_delivery_hours, temperature, wind_speed, risk_score, risk_category
            from dp {where} order by risk_score desc nulls last, order_id limit 50""",
        "weather_impact": f"select temperature, wind_speed, risk_score from dp {where}",
        "risk_histogram": _histogram("risk_score", 20, where),
        "route_metrics": f"""select count(*) routes, round(avg(distance_km) + 1e-9, 4) avg_distance,
            round(avg(estimated_delivery_hours) + 1e-9, 4) avg_hours,
            round(sum(distance_km) / nullif(sum(estimated_delivery_hours), 0) + 1e-9, 4) avg_speed
            from dp {where}""",
        "route_performance": f"""select transport_mode, count(*) shipments,
            round(avg(distance_km) + 1e-9, 4) distance,
            round(avg(estimated_delivery_hours) + 1e-9, 4) as "hours",
            round(sum(distance_km) / nullif(sum(estimated_delivery_hours), 0) + 1e-9, 4) speed
            from dp {where} group by transport_mode""",
        "route_points": f"""select distance_km, estimated_delivery_hours, transport_mode
            from dp {where}""",
        "longest_routes": f"""select route_id, order_id, warehouse_id, transport_mode, distance_km,
            estimated_delivery_hours from dp {where}
            order by distance_km desc nulls last, order_id limit 20""",
        "routes_by_warehouse": f"""select w.name, count(*) routes,
            round(avg(d.distance_km) + 1e-9, 4) avg_distance
            from dp d join warehouses w on d.warehouse_id = w.warehouse_id {on_d}
            group by w.name""",
        "distance_histogram": _histogram("distance_km", 30, where),
    }


def oracles() -> dict[str, str]:
    head = (testbed.sql_views() + f",\nlatest as ({LATEST.format(weather='weather')})"
            + _tables() + _tables("_dirty", "orders_dirty")
            + _tables("_orphaned", "orders_orphaned")
            + f",\nrisk_penalty as ({RISK.format(missing=15, routes='routes')})"
            + ",\ndp_idle as (select * from dp where warehouse_id <> 'WH-001'),"
              "\ndp_none as (select * from dp where false)\n")
    clean = {"dim": "customers", "fact": "fact", "dp": "dp"}
    dirty = {"dim": "customers", "fact": "fact_dirty", "dp": "dp_dirty"}
    staged = """select customer_id, first_name, last_name, email, city, state, country,
       latitude, longitude from customers"""
    body = {
        "routes": "select * from routes",
        "routes_shuffled": "select * from routes",
        "route_profile": """select count(*) routes, min(distance_km) min_km,
            max(distance_km) max_km, round(avg(distance_km) + 1e-9, 4) mean_km,
            min(estimated_hours) min_hours, max(estimated_hours) max_hours,
            round(avg(estimated_hours) + 1e-9, 4) mean_hours,
            count(*) filter (where transport_mode = 'van') van_routes,
            count(*) filter (where transport_mode = 'truck') truck_routes,
            count(*) filter (where transport_mode = 'air') air_routes from routes""",
        "mode_profile": "select transport_mode, count(*) routes from routes group by 1",
        "latest_weather": "select * from latest",
        "latest_weather_tied": LATEST.format(weather="weather_tied"),
        "delivery_risk": "select * from risk",
        "delivery_risk_missing_penalty": "select * from risk_penalty",
        "risk_profile": """select risk_level, count(*) routes, min(risk_score) min_score,
            max(risk_score) max_score from risk group by risk_level""",
        "score_range": "select min(risk_score) min_score, max(risk_score) max_score from risk",
        "customer_labels": """select customer_id, first_name || ' ' || last_name full_name,
            lower(first_name) || '.' || replace(lower(last_name), ' ', '') || '@example.eu' email,
            upper(substring(country, 1, 2)) nationality, round(latitude, 4) latitude,
            round(longitude, 4) longitude from customers""",
        "order_stamps": """select order_id, strftime(created_at, '%Y-%m-%dT%H:%M:%S') iso,
            strftime(created_at, '%Y%m%d_%H%M%S_%f') stamp from ship_orders""",
        "stg_customers": staged,
        "stg_orders": """select order_id, customer_id, warehouse_id, package_weight_kg,
            package_size, priority, status, created_at from ship_orders""",
        "dim_customers": staged,
        "fact_shipments": "select * from fact",
        "fact_shipments_shuffled": "select * from fact",
        "fact_shipments_orphaned": "select * from fact_orphaned",
        "delivery_performance": _DP_ROWS.format("dp"),
        "delivery_performance_joined": _DP_ROWS.format("dp"),
        "delivery_performance_dirty": _DP_ROWS.format("dp_dirty"),
        "delivery_performance_orphaned": _DP_ROWS.format("dp_orphaned"),
        "rebuild": _DP_ROWS.format("dp"),
        # Repeated orders are copies, so the newest of them is any.
        "rebuild_dirty": _DP_ROWS.format(
            "(select distinct * from dp_dirty where order_id is not null "
            "union all select * from dp_dirty where order_id is null)"),
        "overview_metrics_empty": _reports(_where(NO_MATCH))["overview_metrics"],
        "warehouse_performance_idle": _WAREHOUSE.format(dp="dp_idle", where=""),
        "capacity_index_empty": _CAPACITY.format(dp="dp_none", where=""),
        "warehouse_network": """select w.name, w.city, w.country, w.latitude, w.longitude,
            count(d.route_id) routes
            from warehouses w left join dp d on w.warehouse_id = d.warehouse_id
            group by w.name, w.city, w.country, w.latitude, w.longitude""",
        "warehouse_locations": "select name, city, country, latitude, longitude from warehouses",
        "filter_options": """select 'warehouses' kind, name value from warehouses
            union all select distinct 'statuses', status from dp
            union all select distinct 'priorities', priority from dp
            union all select distinct 'risks', risk_category from dp""",
        "dq_marts": _tests_sql(_MART_TESTS, **clean),
        "dq_marts_dirty": _tests_sql(_MART_TESTS, **dirty),
        "dq_ranges": _tests_sql(_RANGE_TESTS),
        "dq_incremental": _tests_sql(_MART_TESTS, **clean),
        "dq_incremental_dirty": _tests_sql(_MART_TESTS, **dirty),
        "route_points_sample": """select distance_km, estimated_delivery_hours, transport_mode from (
              select *, row_number() over (partition by transport_mode order by md5(order_id),
                  distance_km nulls first, estimated_delivery_hours nulls first) rn from dp)
            where rn <= 1000""",
        "weather_impact_sample": """select temperature, wind_speed, risk_score from (
              select *, row_number() over (partition by risk_category order by md5(order_id),
                  temperature nulls first, wind_speed nulls first, risk_score nulls first) rn from dp)
            where rn <= 1000""",
        "dq_orphans": """select customer_id, count(*) "rows" from orders_orphaned
            where customer_id not in (select customer_id from customers) group by customer_id""",
        "dq_failing_status": """select order_id, customer_id, warehouse_id, package_weight_kg,
            package_size, priority, status, created_at from orders_dirty
            where status not in ('created', 'processing', 'shipped', 'delivered', 'cancelled')""",
        "conform_customers": _RAW_OK,
        "conform_rejects": """select customer_id, concat_ws(',',
              case when latitude is null then 'latitude:missing'
                   when try_cast(latitude as double) is null then 'latitude:invalid' end,
              case when longitude is null then 'longitude:missing'
                   when try_cast(longitude as double) is null then 'longitude:invalid' end)
              reject_reason
            from raw_customers where try_cast(latitude as double) is null
                 or try_cast(longitude as double) is null""",
        "dedupe_latest": """select customer_id, version_id, city, changed_at from (
              select *, row_number() over (partition by customer_id
                     order by changed_at desc nulls last, version_id desc) rn
              from customer_versions) where rn = 1""",
        "bronze_replay": _RAW_OK,
        "bronze_weather": """select warehouse_id, "timestamp", temperature,
            wind_speed, timestamp '2026-01-02 03:04:05' ingested_at
            from weather""",
        "weather_history": """select warehouse_id, "timestamp", temperature,
              case when temperature > 20 then 0e0 else wind_speed end wind_speed from (
              select *, row_number() over (partition by warehouse_id, "timestamp"
                     order by temperature > 20 desc, temperature desc, wind_speed desc) rn
              from weather) where rn = 1""",
        "load_audit": """select 'customers' table_name, 'silver' layer,
              (select count(*) from customers) "rows"
            union all select 'warehouses', 'silver', (select count(*) from warehouses)
            union all select 'weather', 'silver', (select count(*) from weather)
            union all select 'orders', 'silver', (select count(*) from ship_orders)
            union all select 'routes', 'gold', (select count(*) from routes)
            union all select 'delivery_risk', 'gold', (select count(*) from risk)
            union all select 'dim_customers', 'mart', (select count(*) from customers)
            union all select 'fact_shipments', 'mart', (select count(*) from fact)
            union all select 'delivery_performance', 'mart', (select count(*) from dp)""",
        "bronze_to_mart": _landed(),
        "conform_types": """select 'CUST-' || c_custkey customer_id,
              case when k not in (1, 2, 3) then 'Ann' end first_name,
              cast(case k when 4 then 42 when 5 then 42 when 7 then 1 when 8 then null
                   else c_custkey % 250 end as bigint) street_number,
              case k when 6 then 52.3676e0 when 9 then null when 10 then 7e0 else 35.25e0 end latitude,
              case when k in (1, 2, 3) then 'first_name:invalid' when k = 8 then 'street_number:invalid'
                   when k = 9 then 'latitude:invalid' when k in (0, 10) then 'email:missing'
                   else '' end reject_reason
            from (select c_custkey, c_custkey % 11 k from customer)""",
        "reference_routes": _reference_routes(),
        "flatten_weather": """select warehouse_id, "timestamp", temperature, wind_speed from weather""",
        "catalog_load": """select customer_id, city, latitude, (select count(*) from customers) loaded
            from customers""",
        "padded_ids": """select s_suppkey, 'WH-' || case when s_suppkey < 1000
              then lpad(cast(s_suppkey as varchar), 3, '0') else cast(s_suppkey as varchar) end warehouse_id
            from supplier""",
        "asof_weather": _ASOF,
        "delivery_risk_asof": f"select * from ({RISK.format(missing=0, routes='routes')})".replace(
            "left join latest l on r.warehouse_id = l.warehouse_id",
            f"left join ({_ASOF}) l on r.order_id = l.order_id"),
        "delivery_risk_asof_dirty": RISK.format(missing=0, routes=f"({_DATED_ROUTES})").replace(
            "left join latest l on r.warehouse_id = l.warehouse_id",
            """asof left join (select * from (select *, row_number() over (
                 partition by warehouse_id, "timestamp" order by event_id desc) rn from weather)
               where rn = 1) l
               on r.warehouse_id = l.warehouse_id and r.created_at >= l."timestamp" """),
        "customer_scd": """select customer_id, version_id, city, changed_at valid_from,
              lead(changed_at) over v valid_to, lead(changed_at) over v is null is_current
            from customer_versions
            window v as (partition by customer_id order by changed_at, version_id)""",
        "customer_scd_merge": """select customer_id, version_id, city, changed_at valid_from,
              lead(changed_at) over v valid_to, lead(changed_at) over v is null is_current
            from (select *, lag(city) over (partition by customer_id order by changed_at, version_id)
                              is distinct from city or row_number() over (
                                partition by customer_id order by changed_at, version_id) = 1 changed
                  from customer_versions) where changed
            window v as (partition by customer_id order by changed_at, version_id)""",
        "stream_timeline": """select cast(created_at as date) "date", count(*) shipments
            from ship_orders group by 1""",
        "stream_timeline_undated": """select cast(created_at as date) "date", count(*) shipments
            from orders_undated group by 1""",
        "stream_dedupe": "select * from ship_orders",
        "stream_dedupe_versions": """select * exclude (rn) from (
              select *, row_number() over (partition by order_id order by created_at, customer_id,
                  warehouse_id, package_weight_kg, package_size, priority, status) rn
              from orders_versions) where rn = 1""",
        "incremental_mart_day": """select * replace (
              case when cast(order_date as date)
                        = (select cast(min(created_at) as date) + 3 from ship_orders)
                   then 'delivered' else status end as status) from dp""",
        "stream_dedupe_unnamed": """select * exclude (rn) from (
              select *, row_number() over (partition by order_id) rn from orders_unnamed)
            where rn = 1 or order_id is null""",
        "bronze_rejects": """select 'unreadable' reason, 'CUST-' || c_custkey customer_id
            from customer where c_custkey % 13 = 0
            union all select 'no results', 'CUST-' || c_custkey from customer
            where c_custkey % 13 = 1""",
        "distance_histogram_nan": _histogram("distance_km", 30, "where risk_category <> 'LOW'"),
        "stream_risk": "select * from risk",
        "incremental_mart": _DP_ROWS.format("dp"),
        "incremental_mart_moved": """select * exclude (moved) replace (
              case when moved then order_date + interval 3 days else order_date end as order_date,
              case when moved then 'delivered' else status end as status)
            from (select *, cast(substring(order_id, 5) as bigint) % 5 = 0 moved from dp)""",
    }
    body["stream_risk_asof"] = body["delivery_risk_asof"]
    body |= _reports()
    chosen = _reports(_where(SOME_FILTERS), _where(SOME_FILTERS, "d."))
    body |= {f"{name}_filtered": sql for name, sql in chosen.items()}
    body["overview_metrics_rollup"] = body["overview_metrics"]
    body["overview_metrics_rollup_filtered"] = body["overview_metrics_filtered"]
    body["overview_metrics_rollup_empty"] = body["overview_metrics_empty"]
    body["customer_metrics_rollup_filtered"] = body["customer_metrics_filtered"]
    return {name: head + sql for name, sql in body.items()}
