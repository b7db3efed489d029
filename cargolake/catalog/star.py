"""Star, marts and reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from cargolake.catalog.registry import query
from cargolake.catalog.views import AS_OF, RUN_TS, STAR_SQL, Views, ctes
from cargolake.functions.numbers import round_mean
from cargolake.operators.aggregates import expenses_by_vehicle_day as vehicle_days, trip_metrics as trips_of
from cargolake.operators.ordered import global_median, global_ntile, global_rank, value_positions
from cargolake.plans import entities, marts, reports

SINCE = date(1996, 1, 1)

CALENDAR_SQL = """
    cal AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS day)
"""


@query(f"""
    WITH {STAR_SQL}, {CALENDAR_SQL},
    base AS (
        SELECT f.customer_id, c.c_name AS name, c.c_mktsegment AS customer_segment,
               date_diff('day', max(full_date), DATE '2001-12-31') AS recency_days,
               count(DISTINCT order_key) AS frequency, sum(net_profit) AS monetary,
               max(full_date) AS last_order_date
        FROM fact f JOIN customer c ON f.customer_id = c.c_custkey JOIN cal ON cal.day = f.full_date
        GROUP BY 1, 2, 3
    ),
    scores AS (
        SELECT *, ntile(4) OVER (ORDER BY recency_days, customer_id) AS recency_score,
               ntile(4) OVER (ORDER BY frequency DESC, customer_id) AS frequency_score,
               ntile(4) OVER (ORDER BY monetary DESC, customer_id) AS monetary_score
        FROM base
    )
    SELECT customer_id, name, customer_segment, CAST(recency_days AS BIGINT) AS recency_days,
           CAST(frequency AS BIGINT) AS frequency, CAST(monetary AS DOUBLE) AS monetary,
           strftime(last_order_date, '%Y-%m-%d') AS last_order_date,
           CAST(recency_score AS BIGINT) AS recency_score, CAST(frequency_score AS BIGINT) AS frequency_score,
           CAST(monetary_score AS BIGINT) AS monetary_score,
           recency_score || '-' || frequency_score || '-' || monetary_score AS rfm_code,
           CASE WHEN recency_score >= 3 AND frequency_score >= 3 AND monetary_score >= 3 THEN 'Champions'
                WHEN recency_score >= 3 AND frequency_score >= 2 THEN 'Loyal'
                WHEN recency_score <= 2 AND frequency_score >= 3 THEN 'Potential'
                WHEN recency_score <= 2 AND frequency_score <= 2 AND monetary_score <= 2 THEN 'At Risk'
                ELSE 'Other' END AS rfm_segment
    FROM scores ORDER BY recency_score DESC, frequency_score DESC, monetary_score DESC, customer_id
""")
def rfm(v: Views) -> DataFrame:
    return reports.rfm(v.fact, v.dim_customer, v.dim_time, AS_OF)


@query(f"""
    WITH {STAR_SQL},
    base AS (
        SELECT f.vehicle_id, s_name AS gov_number, '' || ' ' || 'Model ' || s_nationkey AS car_name,
               count(order_key) AS trips, count(*) AS total_cargo_kg,
               sum(total_vehicle_expense) AS expenses, avg(avg_speed_kmh) AS speed,
               avg(CAST(fuel_expense AS DOUBLE)) AS fuel, sum(net_profit) AS profit
        FROM fact f JOIN supplier ON f.vehicle_id = s_suppkey
        WHERE s_acctbal >= 0 GROUP BY f.vehicle_id, s_name, s_nationkey HAVING count(order_key) >= 5
    ),
    priced AS (
        SELECT *, round(CAST(expenses AS DOUBLE) / CAST(total_cargo_kg AS DOUBLE), 2) AS cost_per_kg FROM base
    ),
    ranked AS (
        SELECT *, median(cost_per_kg) OVER () AS middle, rank() OVER (ORDER BY cost_per_kg) AS efficiency_rank
        FROM priced
    ),
    compared AS (
        SELECT *, cost_per_kg / nullif(middle, 0) * 100 - 100 AS deviation FROM ranked
    )
    SELECT vehicle_id, gov_number, car_name, CAST(trips AS BIGINT) AS trips,
           CAST(total_cargo_kg AS BIGINT) AS total_cargo_kg, CAST(expenses AS DOUBLE) AS total_expenses,
           cost_per_kg, round(speed + sign(speed) * 1e-7, 1) AS avg_speed_kmh,
           round(fuel + sign(fuel) * 1e-7, 4) AS avg_fuel_per_kg, CAST(profit AS DOUBLE) AS profit,
           round(deviation + sign(deviation) * 1e-7, 1) AS cost_per_kg_deviation_pct,
           CAST(efficiency_rank AS BIGINT) AS efficiency_rank
    FROM compared ORDER BY efficiency_rank, vehicle_id
""")
def vehicle_efficiency(v: Views) -> DataFrame:
    return reports.vehicle_efficiency(v.fact, v.dim_vehicle)


@query(f"""
    WITH {STAR_SQL}, {CALENDAR_SQL},
    weekly AS (
        SELECT n_nationkey AS warehouse_id, n_name AS warehouse_name,
               CAST(day - CAST(dayofweek(day) AS INTEGER) AS DATE) AS week_start,
               sum(net_profit) AS weekly_profit, sum(order_amount) AS weekly_revenue
        FROM fact JOIN nation ON warehouse_id = n_nationkey JOIN cal ON cal.day = full_date
        WHERE day >= DATE '1996-01-01' GROUP BY 1, 2, 3
    ),
    figures AS (
        SELECT *, sum(weekly_profit) OVER w AS cum_profit,
               CAST(weekly_profit AS DOUBLE) / nullif(CAST(lag(weekly_profit) OVER w AS DOUBLE), 0) * 100 - 100 AS growth,
               avg(CAST(weekly_profit AS DOUBLE)) OVER (PARTITION BY warehouse_id ORDER BY week_start ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS ma4
        FROM weekly WINDOW w AS (PARTITION BY warehouse_id ORDER BY week_start)
    )
    SELECT warehouse_name, strftime(week_start, '%Y-%m-%d') AS week_start,
           CAST(weekly_profit AS DOUBLE) AS weekly_profit, CAST(cum_profit AS DOUBLE) AS cum_profit,
           CAST(weekly_revenue AS DOUBLE) AS weekly_revenue,
           round(growth + sign(growth) * 1e-7, 1) AS wow_growth_pct,
           round(ma4 + sign(ma4) * 1e-7, 2) AS ma4_profit
    FROM figures ORDER BY warehouse_name, week_start DESC
""")
def weekly_warehouse(v: Views) -> DataFrame:
    return reports.weekly_warehouse(v.fact, v.dim_warehouse, v.dim_time, SINCE)


@query(f"""
    WITH {STAR_SQL},
    margins AS (
        SELECT *, CASE WHEN order_amount > 0 THEN CAST(net_profit AS DOUBLE) / CAST(order_amount AS DOUBLE) * 100 ELSE 0 END AS margin
        FROM fact
    )
    SELECT order_key, '' AS sale_id, time_id, customer_id, driver_id, vehicle_id,
           CAST(warehouse_id AS BIGINT) AS warehouse_id, CAST(order_amount AS DOUBLE) AS order_amount,
           CAST(1 AS BIGINT) AS total_quantity, CAST(order_amount AS DOUBLE) AS gross_profit,
           CAST(fuel_expense AS DOUBLE) AS fuel_expense, CAST(other_expense AS DOUBLE) AS other_expense,
           CAST(wash_expense AS DOUBLE) AS wash_expense,
           CAST(total_vehicle_expense AS DOUBLE) AS total_vehicle_expense,
           trip_duration_minutes, avg_speed_kmh, CAST(net_profit AS DOUBLE) AS net_profit,
           round(margin + sign(margin) * 1e-7, 4) AS margin_percent
    FROM margins
""")
def fact_orders(v: Views) -> DataFrame:
    return v.fact.drop("etl_loaded_at").withColumn(
        "margin_percent", round_mean(F.col("margin_percent"), 4)
    )


@query(f"""
    WITH {STAR_SQL}
    SELECT vehicle_id, strftime(expense_date, '%Y-%m-%d') AS expense_date,
           CAST(fuel_expense AS DOUBLE) AS fuel_expense, CAST(other_expense AS DOUBLE) AS other_expense,
           CAST(wash_expense AS DOUBLE) AS wash_expense, CAST(total_expense AS DOUBLE) AS total_expense
    FROM costs
""")
def expenses_by_vehicle_day(v: Views) -> DataFrame:
    return vehicle_days(v.expenses)


@query(f"WITH {STAR_SQL} SELECT order_key, duration_minutes, avg_speed_kmh FROM trips")
def trip_metrics(v: Views) -> DataFrame:
    return trips_of(v.telemetry)


@query("""
    WITH headers AS (
        SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderpriority END AS comment,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN NULL ELSE o_orderdate END AS created_at,
               CAST(o_totalprice AS DECIMAL(15,2)) AS total_amount
        FROM orders
    ),
    totals AS (
        SELECT l_orderkey AS sale_id,
               coalesce(sum(CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(15,2)) END), 0) AS total
        FROM lineitem GROUP BY l_orderkey
    )
    SELECT CAST(id AS VARCHAR) AS id, coalesce(comment, '') AS comment,
           strftime(created_at, '%Y-%m-%d %H:%M:%S.%g') AS created_at,
           CAST(coalesce(total, total_amount) AS DOUBLE) AS total_amount
    FROM headers LEFT JOIN totals ON id = sale_id
    WHERE created_at IS NOT NULL AND coalesce(total, total_amount) > 0
""")
def sale_header_totals(v: Views) -> DataFrame:
    headers = v.table("orders").selectExpr(
        "o_orderkey AS id",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderpriority END AS comment",
        "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN NULL ELSE o_orderdate END AS created_at",
        "CAST(o_totalprice AS DECIMAL(15,2)) AS total_amount",
    )
    items = v.table("lineitem").selectExpr(
        "l_orderkey AS sale_id",
        "CASE WHEN l_returnflag = 'N' THEN 'n/a' ELSE CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING) END AS amount",
    )
    return entities.clean_sale_headers(headers, items, RUN_TS).drop("etl_updated_at")


@query("""
    WITH span AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
    days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
    SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS time_id, strftime(d, '%Y-%m-%d') AS full_date,
           year(d) AS year, quarter(d) AS quarter, month(d) AS month, isodow(d) AS day_of_week, day(d) AS day,
           dayname(d) AS day_of_week_name, isodow(d) >= 6 AS is_weekend, false AS is_holiday, '' AS holiday_name,
           weekofyear(d) AS week_num, year(d) AS fiscal_year
    FROM days
""")
def dim_time(v: Views) -> DataFrame:
    span = v.table("orders").agg(
        F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("end")
    )
    return marts.calendar(span)


@query("""
    SELECT c_custkey AS customer_id, c_name AS name, '' AS short_name, '' AS inn, '' AS ognr, '' AS contact_person,
           '' AS phone, '' AS email, '' AS address, c_mktsegment AS customer_segment,
           CAST(0 AS DOUBLE) AS credit_limit, true AS is_active, '2002-01-01' AS registration_date
    FROM customer
""")
def dim_customer(v: Views) -> DataFrame:
    return v.dim_customer.drop("etl_updated_at")


@query("""
    SELECT s_suppkey AS vehicle_id, s_name AS gov_number, 'Model ' || s_nationkey AS model, '' AS brand,
           'gasoline' AS fuel_type, CAST(1.6 AS DOUBLE) AS engine_capacity, CAST(0 AS BIGINT) AS max_load_kg,
           '' AS trailer_number, s_acctbal >= 0 AS is_active
    FROM supplier
""")
def dim_vehicle(v: Views) -> DataFrame:
    return v.dim_vehicle.drop("etl_updated_at")


@query("""
    SELECT CAST(n_nationkey AS BIGINT) AS warehouse_id, n_name AS name, '' AS code, '' AS address, '' AS city,
           '' AS region, '' AS responsible_person, true AS is_active, 'standard' AS warehouse_type
    FROM nation
""")
def dim_warehouse(v: Views) -> DataFrame:
    return v.dim_warehouse.drop("etl_updated_at")


@query("""
    SELECT p_partkey AS product_id, p_name AS sku, p_type AS name, '' AS category,
           CASE WHEN p_size < 20 THEN 'pcs' ELSE 'box' END AS unit,
           CASE WHEN p_size > 40 THEN 0 ELSE CAST(CAST(p_size * 30 AS DECIMAL(15,2)) AS DOUBLE) END AS cost_price,
           CAST(CAST(p_retailprice AS DECIMAL(15,2)) AS DOUBLE) AS selling_price, true AS is_active
    FROM part
""")
def dim_product(v: Views) -> DataFrame:
    goods = v.table("part").selectExpr(
        "p_partkey AS id", "p_name AS sku", "p_type AS name",
        "CASE WHEN p_size >= 20 THEN 'box' END AS unit",
        "CASE WHEN p_size <= 40 THEN CAST(p_size * 30 AS DECIMAL(15,2)) END AS cost_price",
        "CAST(p_retailprice AS DECIMAL(15,2)) AS selling_price",
    )
    return marts.dim_product(goods, RUN_TS).drop("etl_updated_at")


@query(f"""
    WITH {ctes('drivers')},
    parts AS (SELECT *, string_split(regexp_replace(trim(full_name), ' +', ' ', 'g'), ' ') AS p FROM drivers)
    SELECT id AS driver_id, full_name, coalesce(p[1], '') AS last_name, coalesce(p[2], '') AS first_name,
           coalesce(p[3], '') AS middle_name, license_number, '' AS license_category, coalesce(phone, '') AS phone,
           '' AS email, coalesce(is_active, true) AS is_active
    FROM parts
""")
def name_split(v: Views) -> DataFrame:
    return marts.dim_driver(v.drivers, RUN_TS).drop("etl_updated_at")


# ---- the ordered operators in their scale-out form, over whole tables ----


@query("""
    SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_extendedprice AS DOUBLE) AS price, CAST(ntile(4) OVER (
        ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS BIGINT) AS tile
    FROM lineitem
""")
def ntile_whole_table(v: Views) -> DataFrame:
    lines = v.table("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_extendedprice").alias("price")
    )
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    tile = global_ntile(lines, 4, "price", False, keys, lines.count())
    return lines.select("l_orderkey", "l_partkey", "l_suppkey", "price", tile.alias("tile"))


@query("""
    WITH ranked AS (
        SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, rank() OVER (ORDER BY l_quantity) AS place,
               median(l_quantity) OVER () AS middle
        FROM lineitem
    )
    SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, CAST(place AS BIGINT) AS place, CAST(middle AS DOUBLE) AS middle FROM ranked
""")
def rank_and_median_whole_table(v: Views) -> DataFrame:
    lines = v.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    positions = value_positions(lines, "l_quantity")
    ranked = global_rank(lines, "l_quantity", positions, "place")
    return ranked.withColumn("middle", global_median("l_quantity", positions))
