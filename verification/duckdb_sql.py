"""DuckDB SQL for every registered query, written independently of the Spark plans.

``with_models(sql)`` prepends the common table expressions the statement mentions.
"""

from __future__ import annotations

import re

_BOOKING_REST = (
    "customer_id experience_id experience_date number_of_guests ticket_price discount_amount "
    "booking_amount booking_channel currency lead_time_days discount_pct booking_status "
    "payment_status"
).split()
_EVENT_REST = (
    "customer_id session_id experience_id event_type device_type traffic_source city_searched"
).split()


def _first_row(table: str, key: str, stamp: str, rest: list[str]) -> str:
    missing = " + ".join(f"({c} IS NULL)::INT" for c in rest)
    ties = ", ".join(f"{c} NULLS FIRST" for c in rest)
    return f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY {key} ORDER BY {stamp} NULLS LAST, {missing}, {ties}) AS rn
            FROM {table}) WHERE rn = 1"""


CTES = {
    "raw_suppliers": """
        SELECT format('SUP{:05d}', s_suppkey) AS supplier_id, s_name AS supplier_name,
               n_name AS country,
               list_extract(['Tour Operator', 'Attraction', 'Museum', 'Theme Park',
                             'Cruise Operator', 'Activity Provider'],
                            (s_suppkey % 6 + 1)::INT) AS supplier_type,
               DATE '2020-01-01' + (s_suppkey % 1000)::INT AS contract_start_date,
               0.10::DOUBLE + (s_suppkey % 21) / 100 AS commission_rate,
               CASE WHEN s_suppkey % 20 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS supplier_status
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        WHERE s_suppkey % 97 <> 13""",
    "raw_experiences": """
        SELECT format('EXP{:06d}', p_partkey) AS experience_id, p_name AS experience_name,
               p_brand AS city, 'NATION_' || (p_size % 25) AS country,
               CASE p_type WHEN 'ECONOMY' THEN 'Adventure' WHEN 'LARGE' THEN 'Cruise'
                    WHEN 'MEDIUM' THEN 'Museum' WHEN 'PROMO' THEN 'Attraction'
                    WHEN 'SMALL' THEN 'Show' WHEN 'STANDARD' THEN 'Theme Park' END AS category,
               CASE WHEN suppkey IS NOT NULL THEN format('SUP{:05d}', suppkey) END
                   AS supplier_id,
               p_retailprice AS base_price, p_size AS capacity,
               3.5::DOUBLE + (p_size % 16) / 10 AS rating,
               p_partkey % 33 <> 0 AS active_flag
        FROM part LEFT JOIN
             (SELECT l_partkey, min(l_suppkey) AS suppkey FROM lineitem GROUP BY l_partkey)
             ON p_partkey = l_partkey
        WHERE p_partkey % 97 <> 0""",
    "raw_customers": """
        SELECT 'C' || c_custkey AS customer_id, CASE WHEN c_custkey % 7 = 0 THEN DATE '2001-11-01'
                    ELSE first_order::DATE END AS signup_date,
               n_name AS country,
               list_extract(['English', 'German', 'French', 'Arabic'],
                            (c_nationkey % 4 + 1)::INT) AS preferred_language,
               list_extract(['Organic', 'Google Ads', 'Meta Ads', 'Affiliate', 'Email',
                             'Direct'], (c_custkey % 6 + 1)::INT) AS acquisition_channel,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'New' WHEN 'BUILDING' THEN 'Repeat'
                    WHEN 'FURNITURE' THEN 'VIP' WHEN 'HOUSEHOLD' THEN 'Dormant'
                    ELSE c_mktsegment END AS customer_segment
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order
                   FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey""",
    "raw_availability": """
        SELECT format('EXP{:06d}', l_partkey) AS experience_id,
               l_shipdate::DATE AS experience_date,
               CASE WHEN l_linenumber % 2 = 0 THEN '09:00' ELSE '11:00' END AS time_slot,
               40 AS total_capacity,
               greatest(0, 40 - sum(l_quantity)::INT) AS available_capacity,
               avg(l_extendedprice / l_quantity) AS price
        FROM lineitem GROUP BY l_partkey, 2, 3""",
    "raw_bookings": """
        SELECT 'B' || (l_orderkey * 10 + l_linenumber) AS booking_id,
               CASE WHEN l_orderkey % 500 <> 0 THEN 'C' || o_custkey END AS customer_id,
               format('EXP{:06d}', l_partkey) AS experience_id,
               o_orderdate AS booking_timestamp, l_shipdate::DATE AS experience_date,
               l_quantity::INT AS number_of_guests, unit AS ticket_price,
               reduction AS discount_amount,
               CASE WHEN l_orderkey % 400 = 1 THEN -amount ELSE amount END AS booking_amount,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'MOBILE' WHEN '2-HIGH' THEN 'MOBILE'
                    WHEN '5-LOW' THEN 'PARTNER' ELSE 'WEB' END AS booking_channel,
               'USD' AS currency,
               ((date_diff('day', o_orderdate::DATE, l_shipdate::DATE) % 121 + 121) % 121)::INT
                   AS lead_time_days,
               pct AS discount_pct,
               CASE l_returnflag WHEN 'N' THEN 'CONFIRMED' WHEN 'A' THEN 'CANCELLED'
                    ELSE 'REFUNDED' END AS booking_status,
               CASE o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'PENDING'
                    ELSE 'FAILED' END AS payment_status
        FROM (SELECT *, floor((unit * l_quantity - reduction) * 100 + 0.5) / 100 AS amount
              FROM (SELECT *, floor(unit * l_quantity * pct * 100) / 100 AS reduction
                    FROM (SELECT *, floor(l_extendedprice / l_quantity * 100) / 100 AS unit,
                                 round(l_discount * 3 + 0.0, 2) AS pct
                          FROM lineitem)))
        JOIN orders ON l_orderkey = o_orderkey
        WHERE o_custkey % 50 <> 0""",
    "raw_web_events": """
        SELECT format('EVT{:07d}', event_id) AS event_id, 'C' || user_id AS customer_id,
               'S' || user_id || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
               CASE WHEN event_type <> 'error' THEN format('EXP{:06d}', k) END
                   AS experience_id,
               ts AS event_timestamp,
               CASE event_type WHEN 'error' THEN 'SEARCH' WHEN 'view' THEN 'VIEW_EXPERIENCE'
                    WHEN 'click' THEN 'CHECK_AVAILABILITY' WHEN 'signup' THEN 'CHECKOUT'
                    WHEN 'purchase' THEN 'PURCHASE' END AS event_type,
               list_extract(['mobile', 'desktop', 'tablet'], (event_id % 3 + 1)::INT)
                   AS device_type,
               list_extract(['organic', 'google_ads', 'meta_ads', 'affiliate', 'email',
                             'direct'], (event_id % 6 + 1)::INT) AS traffic_source,
               'Brand#' || (k % 25 + 1) AS city_searched
        FROM (SELECT *, json_extract_string(props, '$.k')::BIGINT AS k FROM events)""",
    "stg_suppliers": "SELECT * FROM raw_suppliers",
    "stg_experiences": "SELECT * FROM raw_experiences",
    "stg_customers": "SELECT * FROM raw_customers",
    "stg_availability": "SELECT * FROM raw_availability",
    "stg_bookings": _first_row("raw_bookings", "booking_id", "booking_timestamp", _BOOKING_REST),
    "stg_web_events": _first_row("raw_web_events", "event_id", "event_timestamp", _EVENT_REST),
    "int_booking_details": """
        SELECT b.*, e.experience_name, e.city AS experience_city,
               e.country AS experience_country, e.category AS experience_category,
               e.base_price AS experience_base_price, e.capacity AS experience_capacity,
               s.supplier_id, s.supplier_name, s.supplier_type, s.commission_rate
        FROM stg_bookings b
        JOIN stg_experiences e ON b.experience_id = e.experience_id
        JOIN stg_suppliers s ON e.supplier_id = s.supplier_id""",
    "int_orphaned_bookings": """
        SELECT b.booking_id, b.customer_id, b.experience_id, b.booking_timestamp,
               b.booking_amount, b.booking_status, 'INVALID_EXPERIENCE_FK' AS orphan_reason,
               TIMESTAMP '2002-01-01' AS flagged_at
        FROM stg_bookings b LEFT JOIN stg_experiences e ON b.experience_id = e.experience_id
        WHERE e.experience_id IS NULL""",
    "int_customer_activity": """
        SELECT c.customer_id, c.signup_date, c.country, c.acquisition_channel,
               c.customer_segment, first_booking_at, last_booking_at, first_event_at,
               last_event_at,
               coalesce(total_bookings, 0) AS total_bookings,
               coalesce(confirmed_bookings, 0) AS confirmed_bookings,
               coalesce(cancelled_bookings, 0) AS cancelled_bookings,
               coalesce(refunded_bookings, 0) AS refunded_bookings,
               coalesce(lifetime_booking_amount, 0) AS lifetime_booking_amount,
               coalesce(lifetime_confirmed_amount, 0) AS lifetime_confirmed_amount,
               coalesce(total_sessions, 0) AS total_sessions,
               coalesce(search_events, 0) AS search_events,
               coalesce(purchase_events, 0) AS purchase_events,
               coalesce(total_bookings, 0) > 1 AS is_repeat_booker
        FROM stg_customers c
        LEFT JOIN (
            SELECT customer_id, count(*) AS total_bookings,
                   count(*) FILTER (booking_status = 'CONFIRMED') AS confirmed_bookings,
                   count(*) FILTER (booking_status = 'CANCELLED') AS cancelled_bookings,
                   count(*) FILTER (booking_status = 'REFUNDED') AS refunded_bookings,
                   sum(booking_amount) AS lifetime_booking_amount,
                   sum(CASE WHEN booking_status = 'CONFIRMED' THEN booking_amount ELSE 0 END)
                       AS lifetime_confirmed_amount,
                   min(booking_timestamp) AS first_booking_at,
                   max(booking_timestamp) AS last_booking_at
            FROM int_booking_details WHERE customer_id IS NOT NULL GROUP BY customer_id) b
            ON c.customer_id = b.customer_id
        LEFT JOIN (
            SELECT customer_id, count(DISTINCT session_id) AS total_sessions,
                   count(*) FILTER (event_type = 'SEARCH') AS search_events,
                   count(*) FILTER (event_type = 'PURCHASE') AS purchase_events,
                   min(event_timestamp) AS first_event_at,
                   max(event_timestamp) AS last_event_at
            FROM stg_web_events GROUP BY customer_id) s
            ON c.customer_id = s.customer_id""",
    "int_experience_daily_metrics": """
        SELECT e.experience_id, e.experience_name, e.city, e.category, b.avg_lead_time_days,
               a.total_capacity, a.available_capacity, a.experience_date,
               coalesce(b.total_bookings, 0) AS total_bookings,
               coalesce(b.confirmed_bookings, 0) AS confirmed_bookings,
               coalesce(b.cancelled_bookings, 0) AS cancelled_bookings,
               coalesce(b.refunded_bookings, 0) AS refunded_bookings,
               coalesce(b.total_guests, 0)::BIGINT AS total_guests,
               coalesce(b.total_booking_amount, 0) AS total_booking_amount,
               coalesce(b.confirmed_booking_amount, 0) AS confirmed_booking_amount,
               CASE WHEN a.total_capacity > 0 THEN
                   round((a.total_capacity - a.available_capacity) / a.total_capacity, 4) END
                   AS utilization_rate,
               CASE WHEN coalesce(b.total_bookings, 0) > 0 THEN
                   round(b.cancelled_bookings / b.total_bookings, 4) END AS cancellation_rate
        FROM stg_experiences e
        JOIN (SELECT experience_id, experience_date,
                     sum(total_capacity)::BIGINT AS total_capacity,
                     sum(available_capacity)::BIGINT AS available_capacity
              FROM stg_availability GROUP BY 1, 2) a ON e.experience_id = a.experience_id
        LEFT JOIN (
            SELECT experience_id, experience_date, count(*) AS total_bookings,
                   count(*) FILTER (booking_status = 'CONFIRMED') AS confirmed_bookings,
                   count(*) FILTER (booking_status = 'CANCELLED') AS cancelled_bookings,
                   count(*) FILTER (booking_status = 'REFUNDED') AS refunded_bookings,
                   sum(number_of_guests) AS total_guests,
                   sum(booking_amount) AS total_booking_amount,
                   sum(CASE WHEN booking_status = 'CONFIRMED' THEN booking_amount ELSE 0 END)
                       AS confirmed_booking_amount,
                   avg(lead_time_days) AS avg_lead_time_days
            FROM int_booking_details GROUP BY 1, 2) b
            ON e.experience_id = b.experience_id AND a.experience_date = b.experience_date""",
    "dim_customer": """
        SELECT *, date_diff('day', signup_date, DATE '2002-01-01')::INT AS tenure_days
        FROM stg_customers""",
    "dim_supplier": """
        SELECT *, date_diff('day', contract_start_date, DATE '2002-01-01')::INT
                      AS contract_tenure_days
        FROM stg_suppliers""",
    "dim_experience": "SELECT * FROM stg_experiences",
    "dim_date": """
        SELECT d::DATE AS date_day, year(d)::INT AS year, month(d)::INT AS month,
               day(d)::INT AS day_of_month, dayofweek(d)::INT AS day_of_week,
               strftime(d, '%a') AS day_name, strftime(d, '%b') AS month_name,
               quarter(d)::INT AS quarter, weekofyear(d)::INT AS week_of_year,
               dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2024-12-31',
                                            INTERVAL 1 DAY)) AS d)""",
    "fact_bookings": """
        SELECT booking_id, customer_id, experience_id, supplier_id, experience_date AS date_day,
               booking_timestamp, number_of_guests, ticket_price, discount_amount,
               booking_amount, lead_time_days, discount_pct, booking_status, payment_status,
               booking_channel, currency
        FROM int_booking_details""",
    "fact_web_events": """
        SELECT event_id, customer_id, session_id, experience_id,
               event_timestamp::DATE AS date_day, event_timestamp, event_type, device_type,
               traffic_source, city_searched
        FROM stg_web_events""",
    "fact_experience_availability": """
        SELECT experience_id, experience_date AS date_day, time_slot, total_capacity,
               available_capacity, price,
               CASE WHEN total_capacity > 0 THEN
                   round((total_capacity - available_capacity) / total_capacity, 4) END
                   AS utilization_rate
        FROM stg_availability""",
    "ml_daily_price": """
        SELECT experience_id, date_day, avg(price) AS avg_price
        FROM fact_experience_availability GROUP BY 1, 2""",
    "ml_base_features": """
        SELECT dm.experience_id, dm.experience_date AS feature_date, d.day_of_week,
               d.is_weekend, d.month, d.quarter, d.day_name, e.city, e.category, e.capacity,
               e.rating, e.base_price, dp.avg_price, dm.total_bookings AS target_bookings,
               dm.confirmed_bookings AS target_confirmed_bookings,
               dm.cancellation_rate AS target_cancellation_rate,
               dm.utilization_rate AS target_utilization_rate
        FROM int_experience_daily_metrics dm
        JOIN dim_experience e ON dm.experience_id = e.experience_id
        JOIN dim_date d ON dm.experience_date = d.date_day
        LEFT JOIN ml_daily_price dp ON dm.experience_id = dp.experience_id
             AND dm.experience_date = dp.date_day""",
    "ml_rolling_features": """
        SELECT b.*,
               lag(dm.total_bookings) OVER w AS bookings_prev_1d,
               avg(dm.total_bookings) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
                   AS bookings_prev_7d_avg,
               avg(dm.total_bookings) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)
                   AS bookings_prev_28d_avg,
               avg(dm.utilization_rate) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
                   AS utilization_prev_7d_avg,
               avg(dm.cancellation_rate) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)
                   AS cancellation_rate_prev_28d_avg,
               (row_number() OVER w - 1)::INT AS days_of_prior_history
        FROM ml_base_features b JOIN int_experience_daily_metrics dm
          ON b.experience_id = dm.experience_id AND b.feature_date = dm.experience_date
        WINDOW w AS (PARTITION BY b.experience_id ORDER BY b.feature_date)""",
    "ml_demand_features": """
        SELECT experience_id, feature_date, day_of_week, is_weekend, month, quarter, day_name,
               city, category, capacity, rating, base_price, avg_price, bookings_prev_1d,
               bookings_prev_7d_avg, bookings_prev_28d_avg, utilization_prev_7d_avg,
               cancellation_rate_prev_28d_avg, days_of_prior_history, target_bookings,
               target_confirmed_bookings, target_cancellation_rate, target_utilization_rate
        FROM ml_rolling_features""",
}


def with_models(sql: str) -> str:
    """Prepend the CTEs ``sql`` needs, in dependency order."""
    wanted: set[str] = set()

    def collect(text: str) -> None:
        for name in CTES:
            if name not in wanted and re.search(rf"\b{name}\b", text):
                wanted.add(name)
                collect(CTES[name])

    collect(sql)
    if not wanted:
        return sql
    parts = [f"{name} AS ({CTES[name]})" for name in CTES if name in wanted]
    return "WITH " + ",\n".join(parts) + "\n" + sql


def _model(name: str, digits: int = 4, columns: str = "", **special: int) -> str:
    """All rows of a model with its inexact columns rounded."""
    digits_of = {**{c: digits for c in columns.split()}, **special}
    replaced = ", ".join(f"round({c}, {d}) AS {c}" for c, d in digits_of.items())
    return f"SELECT * REPLACE ({replaced}) FROM {name}" if replaced else f"SELECT * FROM {name}"


_GMV = "sum(CASE WHEN booking_status = 'CONFIRMED' THEN booking_amount ELSE 0 END)"
_LOST = "count(*) FILTER (booking_status IN ('CANCELLED', 'REFUNDED'))"
_STAR = "fact_bookings fb JOIN dim_experience de ON fb.experience_id = de.experience_id"
_BUCKET = """CASE WHEN lead_time_days < 3 THEN '<3d' WHEN lead_time_days < 14 THEN '3-14d'
                  WHEN lead_time_days < 60 THEN '14-60d' ELSE '>60d' END"""
_STAGE = """nullif(list_position(['SEARCH', 'VIEW_EXPERIENCE', 'CHECK_AVAILABILITY',
                                  'ADD_TO_CART', 'CHECKOUT', 'PURCHASE'], event_type), 0)"""
_SEASON = """list_extract([0.80, 0.80, 0.90, 1.00, 1.05, 1.20, 1.30, 1.30, 1.05, 0.95, 0.90,
                           1.15]::DOUBLE[], month({day}))"""
_SLOTS = """CASE category WHEN 'Theme Park' THEN 4 WHEN 'Attraction' THEN 3
                 WHEN 'Museum' THEN 3 WHEN 'Adventure' THEN 1 ELSE 2 END"""


def _kpis(where: str) -> str:
    return f"""
        SELECT count(*) AS total_bookings, round({_GMV}, 4) AS gmv,
               round({_LOST} / nullif(count(*), 0), 4) AS cancellation_rate
        FROM {_STAR} WHERE {where}"""


def _trend(where: str) -> str:
    return f"""
        SELECT year, month, month_name, count(*) AS bookings, round({_GMV}, 4) AS revenue
        FROM {_STAR} JOIN dim_date dd ON fb.date_day = dd.date_day
        WHERE {where} GROUP BY ALL"""


def _by_city(where: str) -> str:
    return f"SELECT city, round({_GMV}, 4) AS revenue FROM {_STAR} WHERE {where} GROUP BY city"


def _top(where: str, limit: int) -> str:
    return f"""
        SELECT experience_name, city, category, sum(total_bookings)::BIGINT AS bookings,
               round(sum(total_capacity - available_capacity) / sum(total_capacity), 4)
                   AS avg_utilization,
               round(sum(confirmed_booking_amount), 4) AS revenue
        FROM int_experience_daily_metrics WHERE {where}
        GROUP BY 1, 2, 3 ORDER BY bookings DESC, 1, 2, 3 LIMIT {limit}"""


def _lead_time(where: str) -> str:
    return f"""
        SELECT {_BUCKET} AS lead_time_bucket, count(*) AS total_bookings,
               round({_LOST} / count(*), 4) AS cancellation_rate
        FROM {_STAR} WHERE {where} GROUP BY 1"""


def _channels(where: str) -> str:
    return f"""
        SELECT booking_channel, count(*) AS bookings, round({_GMV}, 4) AS revenue
        FROM {_STAR} WHERE {where} GROUP BY 1"""


_PRIOR = f"""
    SELECT booking_id, customer_id, booking_timestamp, lead_time_days, discount_pct,
           booking_channel, experience_category AS category, booking_status,
           CASE WHEN customer_id IS NULL THEN 0 ELSE coalesce(
               count(*) FILTER (booking_status IN ('CANCELLED', 'REFUNDED')) OVER (
                   PARTITION BY customer_id ORDER BY booking_timestamp, booking_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END::BIGINT
               AS prior_cancellations
    FROM int_booking_details"""

_RISK = f"""
    SELECT *, least(greatest(0.10 * multiplier, 0.02), 0.85) AS risk FROM (
        SELECT booking_id, customer_id, lead_time_days, booking_status, prior_cancellations,
               (CASE WHEN lead_time_days > 60 THEN 1.6 WHEN lead_time_days >= 14 THEN 1.2
                     WHEN lead_time_days < 3 THEN 0.5 ELSE 1 END)::DOUBLE
               * (CASE WHEN discount_pct > 0.20 THEN 1.3 ELSE 1 END)::DOUBLE
               * (CASE WHEN booking_channel = 'PARTNER' THEN 1.25 ELSE 1 END)::DOUBLE
               * (CASE WHEN category IN ('Adventure', 'Cruise') THEN 1.3
                       WHEN category IN ('Museum', 'Attraction') THEN 0.85 ELSE 1 END)::DOUBLE
               * (CASE WHEN prior_cancellations = 1 THEN 1.4
                       WHEN prior_cancellations >= 2 THEN 1.9 ELSE 1 END)::DOUBLE AS multiplier
        FROM ({_PRIOR}))"""

_INVENTORY = """
    SELECT experience_id, experience_date, total_capacity, total_guests AS booked_guests,
           greatest(0, total_capacity - total_guests) AS expected_available,
           available_capacity AS stored_available,
           available_capacity - greatest(0, total_capacity - total_guests) AS difference
    FROM int_experience_daily_metrics"""

_SESSIONS = f"""
    SELECT session_id, min(event_timestamp) AS first_event_at,
           max(event_timestamp) AS last_event_at, count(*) AS events,
           max({_STAGE})::INT AS deepest_stage,
           count(*) FILTER (event_type = 'PURCHASE') > 0 AS converted
    FROM stg_web_events GROUP BY session_id"""

_STEPS = f"""
    SELECT session_id, event_id, event_timestamp, event_type, {_STAGE} AS stage,
           lag(event_timestamp) OVER w AS previous_timestamp,
           lag({_STAGE}) OVER w AS previous_stage
    FROM stg_web_events WINDOW w AS (PARTITION BY session_id ORDER BY event_timestamp, event_id)"""

_UNBOOKED = """
    FROM {left} l WHERE NOT EXISTS (SELECT 1 FROM {right} r
        WHERE l.customer_id = r.customer_id AND l.experience_id = r.experience_id
          AND l.{left_time} = r.{right_time})"""


#: Bookings as files with dirt in them, and why a row is refused (NULL: it isn't).
_DIRTY = """
    SELECT * EXCLUDE (unread, place),
           nullif(concat_ws('; ', unread, CASE WHEN NOT coalesce(booking_amount >= 0, false) THEN 'rule: booking_amount >= 0' END,
                            CASE WHEN place > 1 AND unread = '' THEN 'rule: unique booking_id' END)[
               CASE WHEN unread = '' THEN 3 ELSE 1 END:], '') AS reason
    FROM (
        SELECT *, row_number() OVER (
                   PARTITION BY booking_id
                   ORDER BY unread <> '', booking_timestamp NULLS LAST, customer_id NULLS FIRST, experience_id,
                            experience_date, number_of_guests, ticket_price, discount_amount,
                            booking_amount NULLS FIRST, booking_channel, currency NULLS FIRST, lead_time_days,
                            discount_pct, booking_status, payment_status) AS place
        FROM (
            SELECT * REPLACE (CASE WHEN n % 103 <> 0 THEN booking_amount END AS booking_amount,
                              CASE WHEN n % 107 <> 0 THEN customer_id END AS customer_id,
                              CASE WHEN n % 109 <> 0 THEN currency END AS currency),
                   concat_ws('; ', CASE WHEN n % 113 = 0 THEN 'booking_timestamp: yesterday' END,
                             CASE WHEN n % 101 = 0 THEN 'number_of_guests: many' END) AS unread
            FROM (SELECT *, substr(booking_id, 2)::BIGINT AS n FROM raw_bookings)
            JOIN (VALUES (0), (1)) AS c(copy) ON copy = 0 OR n % 127 = 0))"""
_PURCHASES = """(
    SELECT event_id, customer_id, experience_id, event_timestamp
    FROM stg_web_events WHERE event_type = 'PURCHASE'
    UNION ALL
    SELECT 'EVT-' || booking_id, customer_id, experience_id,
           booking_timestamp + to_minutes((n % 80 - 10)::BIGINT)
    FROM (SELECT *, substr(booking_id, 2)::BIGINT AS n FROM stg_bookings)
    WHERE n % 3 = 0 AND customer_id IS NOT NULL)"""
_NEAR_BOOKING = """
    p.customer_id = b.customer_id AND p.experience_id = b.experience_id
    AND b.booking_timestamp BETWEEN p.event_timestamp - INTERVAL 1 HOUR
                                AND p.event_timestamp + INTERVAL 1 HOUR"""
#: Events in four stretches of time, those that come late, and those that come twice.
_DEALT = """
    SELECT *, substr(event_id, 4)::BIGINT AS n,
           (epoch_us(event_timestamp) - min(epoch_us(event_timestamp)) OVER ()) * 4
           // (max(epoch_us(event_timestamp)) OVER () - min(epoch_us(event_timestamp)) OVER () + 1) AS part
    FROM raw_web_events"""


def _matching_rounds(rounds: int) -> str:
    """Greedy one-to-one matching, as many mutual-nearest rounds as written out."""
    text = f"""
        open0 AS (
            SELECT event_id, booking_id,
                   abs(epoch_us(p.event_timestamp) - epoch_us(b.booking_timestamp)) AS apart
            FROM purchase_log p JOIN stg_bookings b ON {_NEAR_BOOKING})"""
    for k in range(rounds):
        text += f""",
        pairs{k} AS (
            SELECT event_id, booking_id, apart
            FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY apart, booking_id) AS a,
                         row_number() OVER (PARTITION BY booking_id ORDER BY apart, event_id) AS b
                  FROM open{k}) WHERE a = 1 AND b = 1),
        open{k + 1} AS (
            SELECT * FROM open{k} WHERE event_id NOT IN (SELECT event_id FROM pairs{k})
                                    AND booking_id NOT IN (SELECT booking_id FROM pairs{k}))"""
    return text


_STAGES = (
    "'SEARCH', 'VIEW_EXPERIENCE', 'CHECK_AVAILABILITY', 'ADD_TO_CART', 'CHECKOUT', 'PURCHASE'"
)

# model | kind | column(s) | severity | detail
_CHECKS = f"""
stg_suppliers | key | supplier_id | error |
stg_suppliers | accepted_values | supplier_status | error | 'ACTIVE', 'INACTIVE'
stg_experiences | key | experience_id | error |
stg_experiences | relationships | supplier_id | error | stg_suppliers
stg_experiences | expression | base_price | error | > 0
stg_customers | key | customer_id | error |
stg_customers | accepted_values | customer_segment | error | 'New', 'Repeat', 'VIP', 'Dormant'
stg_availability | relationships | experience_id | error | stg_experiences
stg_availability | unique_combination | experience_id,experience_date,time_slot | error |
stg_bookings | key | booking_id | error |
stg_bookings | not_null | customer_id | warn |
stg_bookings | relationships | experience_id | warn | stg_experiences
stg_bookings | accepted_values | booking_status | error | 'CONFIRMED', 'CANCELLED', 'REFUNDED'
stg_bookings | expression | booking_amount | warn | >= 0
stg_web_events | key | event_id | error |
stg_web_events | relationships | customer_id | error | stg_customers
stg_web_events | accepted_values | event_type | error | {_STAGES}
int_booking_details | key | booking_id | error |
int_booking_details | relationships | experience_id | error | stg_experiences
int_booking_details | relationships | supplier_id | error | stg_suppliers
int_orphaned_bookings | key | booking_id | error |
int_orphaned_bookings | accepted_values | orphan_reason | error | 'INVALID_EXPERIENCE_FK'
int_customer_activity | key | customer_id | error |
int_customer_activity | expression | total_bookings | error | >= 0
int_customer_activity | expression | confirmed_bookings | error | <= total_bookings
int_experience_daily_metrics | relationships | experience_id | error | stg_experiences
int_experience_daily_metrics | unique_combination | experience_id,experience_date | error |
dim_customer | key | customer_id | error |
dim_supplier | key | supplier_id | error |
dim_experience | key | experience_id | error |
dim_experience | expression | rating | error | between 0 and 5
dim_experience | relationships | supplier_id | error | dim_supplier
dim_date | key | date_day | error |
fact_bookings | key | booking_id | error |
fact_bookings | relationships | customer_id | warn | dim_customer
fact_bookings | relationships | experience_id | error | dim_experience
fact_bookings | relationships | date_day | error | dim_date
fact_bookings | expression | number_of_guests | error | >= 1
fact_web_events | key | event_id | error |
fact_web_events | relationships | customer_id | error | dim_customer
fact_web_events | relationships | date_day | error | dim_date
fact_experience_availability | relationships | experience_id | error | dim_experience
fact_experience_availability | relationships | date_day | error | dim_date
fact_experience_availability | unique_combination | experience_id,date_day,time_slot | error |
ml_daily_price | relationships | experience_id | error | dim_experience
ml_daily_price | unique_combination | experience_id,date_day | error |
ml_base_features | relationships | experience_id | error | dim_experience
ml_base_features | not_null | target_bookings | error |
ml_base_features | unique_combination | experience_id,feature_date | error |
ml_rolling_features | expression | days_of_prior_history | error | >= 0
ml_rolling_features | unique_combination | experience_id,feature_date | error |
ml_demand_features | relationships | experience_id | error | dim_experience
ml_demand_features | not_null | target_bookings | error |
ml_demand_features | unique_combination | experience_id,feature_date | error |
"""


def _check_sql(model: str, kind: str, column: str, severity: str, detail: str) -> str:
    found = {
        "unique": f"(SELECT {column} FROM {model} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1)",
        "unique_combination": f"(SELECT {column} FROM {model} GROUP BY {column} "
        "HAVING count(*) > 1)",
        "not_null": f"{model} WHERE {column} IS NULL",
        "accepted_values": f"{model} WHERE {column} NOT IN ({detail})",
        "expression": f"{model} WHERE NOT ({column} {detail})",
        "relationships": f"{model} c WHERE {column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {detail} p WHERE p.{column} = c.{column})",
    }[kind]
    return (
        f"SELECT '{kind}:{column}' AS \"check\", '{model}' AS \"table\", "
        f"'{column}' AS \"column\", '{severity}' AS severity, count(*) AS violations FROM {found}"
    )


def _dq_summary() -> str:
    parts = [
        "SELECT 'booking_split_conserves_rows' AS \"check\", 'stg_bookings' AS \"table\", "
        "'booking_id' AS \"column\", 'error' AS severity, CASE WHEN "
        "(SELECT count(*) FROM stg_bookings) <> (SELECT count(*) FROM int_booking_details) "
        "+ (SELECT count(*) FROM int_orphaned_bookings) THEN 1 ELSE 0 END AS violations"
    ]
    for line in _CHECKS.strip().splitlines():
        model, kind, column, severity, detail = [part.strip() for part in line.split("|")]
        for single in ("unique", "not_null") if kind == "key" else (kind,):
            parts.append(_check_sql(model, single, column, severity, detail))
    return "\nUNION ALL\n".join(parts)


def _violations(label: str, rules: dict[str, str]) -> str:
    rows = [
        f"SELECT {label}, '{rule}' AS rule, count(*) AS violations FROM {source}"
        for rule, source in rules.items()
    ]
    return " UNION ALL ".join(rows)


def _repeats(label: str, rule: str, table: str, key: str) -> str:
    distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {key} FROM {table}))"
    return f"SELECT {label}, '{rule}' AS rule, count(*) - {distinct} AS violations FROM {table}"


_TRAINING = "SELECT * FROM ml_demand_features WHERE bookings_prev_7d_avg IS NOT NULL AND bookings_prev_28d_avg IS NOT NULL"  # noqa: E501
_LAST_DAY = f"(SELECT max(feature_date) - 60 FROM ({_TRAINING}))"


def _baseline(name: str, column: str) -> str:
    error = f"(target_bookings - coalesce({column}, 0))"
    return f"""
        SELECT '{name}' AS model, round(avg(abs({error})), 3) AS mae,
               round(sqrt(avg({error} * {error})), 3) AS rmse, count(*) AS n
        FROM ({_TRAINING}) WHERE feature_date > {_LAST_DAY}"""


def statements() -> dict[str, str]:
    city, category = "city = 'Brand#7'", "category = 'Museum'"
    money = "lifetime_booking_amount lifetime_confirmed_amount"
    averages = (
        "bookings_prev_7d_avg bookings_prev_28d_avg utilization_prev_7d_avg "
        "cancellation_rate_prev_28d_avg"
    )
    texts = {
        "stg_suppliers": _model("stg_suppliers", columns="commission_rate"),
        "stg_experiences": _model("stg_experiences", columns="rating"),
        "stg_customers": _model("stg_customers"),
        "stg_availability": _model("stg_availability", price=7),
        "stg_bookings_dedup": _model("stg_bookings"),
        "stg_web_events": _model("stg_web_events"),
        "booking_details": _model("int_booking_details", columns="commission_rate"),
        "orphaned_bookings": _model("int_orphaned_bookings"),
        "customer_activity": _model("int_customer_activity", columns=money),
        "experience_daily_metrics": _model(
            "int_experience_daily_metrics",
            columns="avg_lead_time_days total_booking_amount confirmed_booking_amount",
        ),
        "dim_customer": _model("dim_customer"),
        "dim_supplier": _model("dim_supplier", columns="commission_rate"),
        "dim_experience": _model("dim_experience", columns="rating"),
        "dim_date": """
            SELECT * FROM dim_date
            WHERE date_day BETWEEN (SELECT min(experience_date) FROM stg_availability)
                               AND (SELECT max(experience_date) FROM stg_availability)""",
        "fact_bookings": _model("fact_bookings"),
        "fact_web_events": _model("fact_web_events"),
        "fact_availability": _model("fact_experience_availability", price=7),
        "ml_daily_price": _model("ml_daily_price", avg_price=7),
        "ml_base_features": _model("ml_base_features", columns="rating", avg_price=7),
        "ml_rolling_features": _model(
            "ml_rolling_features", 8, f"rating {averages}", avg_price=7
        ),
        "ml_demand_features": _model("ml_demand_features", 8, f"rating {averages}", avg_price=7),
        "filter_options": """
            SELECT DISTINCT 'city' AS filter, city AS value FROM dim_experience
            UNION ALL SELECT DISTINCT 'category', category FROM dim_experience""",
        "kpis_all": _kpis("true"),
        "kpis_filtered": _kpis(f"{city} AND {category}"),
        "kpis_nothing_matches": _kpis("city = 'Nowhere'"),
        "repeat_customer_rate": """
            SELECT round(coalesce(avg(CASE WHEN is_repeat_booker THEN 1.0 ELSE 0.0 END), 0), 6)
                   AS repeat_rate
            FROM int_customer_activity WHERE total_bookings > 0""",
        "monthly_trend": _trend("true"),
        "monthly_trend_filtered": _trend(f"{city} AND {category}"),
        "city_growth": f"""
            SELECT city, year, month, bookings, previous_bookings,
                   round((bookings - previous_bookings) / previous_bookings, 6) AS growth
            FROM (SELECT *, lag(bookings) OVER (PARTITION BY city ORDER BY year, month)
                                AS previous_bookings
                  FROM (SELECT city, year, month, count(*) AS bookings
                        FROM {_STAR} JOIN dim_date dd ON fb.date_day = dd.date_day
                        GROUP BY 1, 2, 3))""",
        "revenue_by_city": _by_city("true"),
        "revenue_by_city_filtered": _by_city(category),
        "funnel": """
            SELECT event_type, count(DISTINCT session_id) AS sessions
            FROM fact_web_events GROUP BY 1""",
        "top_experiences": _top("true", 10),
        "top_experiences_filtered": _top(f"{city} AND {category}", 5),
        "cancellation_by_lead_time": _lead_time("true"),
        "cancellation_by_lead_time_filtered": _lead_time(city),
        "channel_mix": _channels("true"),
        "channel_mix_filtered": _channels(category),
        "metric_cancellation_rate": f"""
            SELECT category, booking_channel, round({_LOST} / count(*), 4) AS cancellation_rate
            FROM {_STAR} GROUP BY 1, 2""",
        "metric_gmv_by_year": f"""
            SELECT year, city, round({_GMV}, 4) AS gmv
            FROM {_STAR} JOIN dim_date dd ON fb.date_day = dd.date_day GROUP BY 1, 2""",
        "metric_total_bookings": f"SELECT count(*) AS total_bookings FROM {_STAR}",
        "metric_repeat_by_segment": """
            SELECT customer_segment, round(avg(CASE WHEN is_repeat_booker THEN 1.0 ELSE 0.0 END),
                                           6) AS repeat_customer_rate
            FROM int_customer_activity WHERE total_bookings > 0 GROUP BY 1""",
        "price_calendar": f"""
            SELECT experience_id, day::DATE AS experience_date,
                   unnest((['09:00', '11:00', '13:00', '15:00', '17:00'])[1:{_SLOTS}])
                       AS time_slot,
                   greatest(1, capacity // {_SLOTS})::INT AS total_capacity,
                   greatest(1, capacity // {_SLOTS})::INT AS available_capacity,
                   round(base_price * {_SEASON.format(day="day")}
                         * (CASE WHEN dayofweek(day) IN (0, 6) THEN 1.15 ELSE 1 END)::DOUBLE,
                         2) AS price
            FROM (SELECT *, unnest(generate_series(TIMESTAMP '1996-06-27',
                                                   TIMESTAMP '1996-07-03',
                                                   INTERVAL 1 DAY)) AS day
                  FROM dim_experience WHERE active_flag)""",
        "expected_demand": f"""
            SELECT m.experience_id, m.experience_date, m.total_bookings,
                   round(own / (SELECT avg(total_bookings) FROM int_experience_daily_metrics), 6)
                       AS popularity,
                   round(own / (SELECT avg(total_bookings) FROM int_experience_daily_metrics)
                     * {_SEASON.format(day="m.experience_date")}
                     * (CASE WHEN dayofweek(m.experience_date) IN (0, 6) THEN 1.35
                             ELSE 1 END)::DOUBLE
                     * greatest(0.3, 1.4::DOUBLE - 0.6::DOUBLE * (p.avg_price / base_price))
                     * (CASE WHEN rating >= 4.5 THEN 1.15 WHEN rating < 4.0 THEN 0.85
                             ELSE 1 END)::DOUBLE, 6) AS expected_bookings
            FROM int_experience_daily_metrics m
            JOIN (SELECT experience_id, avg(total_bookings) AS own
                  FROM int_experience_daily_metrics GROUP BY 1) o USING (experience_id)
            JOIN dim_experience e USING (experience_id)
            JOIN ml_daily_price p ON p.experience_id = m.experience_id
                 AND p.date_day = m.experience_date""",
        "prior_cancellations": _PRIOR,
        "cancellation_counts": """
            SELECT customer_id, count(*) AS cancellation_count FROM fact_bookings
            WHERE booking_status IN ('CANCELLED', 'REFUNDED') AND customer_id IS NOT NULL
            GROUP BY 1""",
        "cancellation_risk": f"""
            SELECT * REPLACE (round(multiplier, 6) AS multiplier, round(risk, 6) AS risk)
            FROM ({_RISK})""",
        "risk_calibration": f"""
            SELECT {_BUCKET} AS lead_time_bucket, count(*) AS bookings,
                   round(avg(risk), 6) AS predicted_rate,
                   round({_LOST} / count(*), 6) AS actual_rate
            FROM ({_RISK}) GROUP BY 1""",
        "inventory_reconciliation": _INVENTORY,
        "over_capacity": f"SELECT * FROM ({_INVENTORY}) WHERE booked_guests > total_capacity",
        "near_capacity": """
            SELECT experience_id, experience_date, utilization_rate
            FROM int_experience_daily_metrics WHERE utilization_rate >= 0.9""",
        "amount_mismatches": """
            SELECT booking_id, booking_amount, expected_amount FROM (
                SELECT booking_id, booking_amount,
                       round(greatest(0, round(ticket_price * number_of_guests
                                               - discount_amount, 2)), 4) AS expected_amount
                FROM stg_bookings)
            WHERE abs(booking_amount - expected_amount) > 0.005""",
        "funnel_dropoff": f"""
            SELECT stage::INT AS stage, event_type, sessions,
                   round(sessions / lag(sessions) OVER (ORDER BY stage), 6) AS step_conversion,
                   round(sessions / first(sessions) OVER (ORDER BY stage), 6)
                       AS overall_conversion
            FROM (SELECT {_STAGE} AS stage, event_type, count(DISTINCT session_id) AS sessions
                  FROM fact_web_events GROUP BY 1, 2) WHERE stage IS NOT NULL""",
        "session_summary": _SESSIONS,
        "browsing_session_length": f"""
            SELECT count(*) AS sessions, round(avg(events), 6) AS mean_events
            FROM ({_SESSIONS}) WHERE NOT converted""",
        "session_order_violations": f"""
            SELECT * FROM (
                SELECT session_id, event_id, event_timestamp, event_type,
                       coalesce(event_timestamp <= previous_timestamp, false) AS not_later,
                       coalesce(stage < previous_stage, false) AS stage_went_back
                FROM ({_STEPS})) WHERE not_later OR stage_went_back""",
        "session_gaps": f"""
            SELECT session_id, event_id, event_type,
                   round(date_diff('microsecond', previous_timestamp, event_timestamp)
                         / 60000000.0::DOUBLE, 8) AS gap_minutes
            FROM ({_STEPS}) WHERE previous_timestamp IS NOT NULL""",
        "segment_violations": """
            SELECT customer_id, customer_segment, tenure_days FROM dim_customer
            WHERE tenure_days < 90 AND customer_segment NOT IN ('New', 'Repeat')""",
        "late_bookings": """
            SELECT booking_id, booking_timestamp, experience_date FROM stg_bookings
            WHERE booking_timestamp >= experience_date::TIMESTAMP""",
        "lead_time_windows": """
            SELECT CASE WHEN lead_time_days BETWEEN 1 AND 7 THEN 'short'
                        WHEN lead_time_days BETWEEN 8 AND 30 THEN 'medium'
                        WHEN lead_time_days BETWEEN 31 AND 120 THEN 'long' END AS booking_window,
                   count(*) AS bookings,
                   count(*) FILTER (lead_time_days = date_diff('day', booking_timestamp::DATE,
                                                               experience_date))
                       AS lead_time_as_derived
            FROM stg_bookings GROUP BY 1""",
        "bookings_before_signup": """
            SELECT booking_id, b.customer_id, booking_timestamp, signup_date
            FROM stg_bookings b JOIN stg_customers c ON b.customer_id = c.customer_id
            WHERE booking_timestamp::DATE < signup_date""",
        "bookings_without_inventory": """
            SELECT booking_id, experience_id, experience_date FROM stg_bookings b
            WHERE NOT EXISTS (SELECT 1 FROM stg_availability a
                WHERE a.experience_id = b.experience_id
                  AND a.experience_date = b.experience_date)""",
        "purchase_reconciliation": f"""
            SELECT (SELECT count(*) FROM stg_web_events WHERE event_type = 'PURCHASE')
                       AS purchases,
                   (SELECT count(*) FROM stg_bookings) AS bookings,
                   (SELECT count(*) {_UNBOOKED.format(
                       left="(SELECT * FROM stg_web_events WHERE event_type = 'PURCHASE')",
                       right="stg_bookings", left_time="event_timestamp",
                       right_time="booking_timestamp")}) AS purchases_without_booking,
                   (SELECT count(*) {_UNBOOKED.format(
                       left="stg_bookings",
                       right="(SELECT * FROM stg_web_events WHERE event_type = 'PURCHASE')",
                       left_time="booking_timestamp", right_time="event_timestamp")})
                       AS bookings_without_purchase,
                   (SELECT count(*) FROM stg_web_events WHERE event_type = 'PURCHASE')
                       = (SELECT count(*) FROM stg_bookings) AS counts_agree""",
        "value_distribution": """
            SELECT booking_status, count(*) AS n_rows,
                   round(count(*) / (SELECT count(*) FROM stg_bookings), 6) AS share
            FROM stg_bookings GROUP BY 1""",
    }
    texts.update(_quality())
    texts.update(_forecasting())
    texts.update(_other())
    return {name: with_models(text) for name, text in texts.items()}


def _quality() -> dict[str, str]:
    details = "(SELECT count(*) FROM int_booking_details)"
    orphans = "(SELECT count(*) FROM int_orphaned_bookings)"
    booking_columns = ["booking_id", "booking_timestamp", *_BOOKING_REST]
    raw_tables = "suppliers experiences customers availability bookings web_events".split()
    stg_orphans = {
        "booking customer exists": ("stg_bookings", "customer_id", "stg_customers"),
        "booking experience exists": ("stg_bookings", "experience_id", "stg_experiences"),
        "experience supplier exists": ("stg_experiences", "supplier_id", "stg_suppliers"),
        "event customer exists": ("stg_web_events", "customer_id", "stg_customers"),
    }
    invariant_rows = [
        f"SELECT '{name}' AS invariant, count(*) AS violations FROM {child} c "
        f"WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {parent})"
        for name, (child, key, parent) in stg_orphans.items()
    ]
    return {
        "booking_split_counts": f"""
            SELECT count(*) AS staging_row_count, {details} AS details_row_count,
                   {orphans} AS orphan_row_count, {details} + {orphans} AS split_row_count
            FROM stg_bookings""",
        "booking_split_conservation": f"""
            SELECT * FROM (SELECT count(*) AS staging_row_count,
                                  {details} + {orphans} AS split_row_count FROM stg_bookings)
            WHERE staging_row_count <> split_row_count""",
        "unaccounted_bookings": """
            SELECT booking_id FROM stg_bookings
            WHERE booking_id NOT IN (SELECT booking_id FROM int_booking_details)
              AND booking_id NOT IN (SELECT booking_id FROM int_orphaned_bookings)""",
        "dq_summary": _dq_summary(),
        "dq_profile": f"""
            SELECT 'duplicate_booking' AS defect,
                   count(*) - count(DISTINCT booking_id) AS n_rows FROM raw_bookings
            UNION ALL SELECT 'duplicate_event', count(*) - count(DISTINCT event_id)
                      FROM raw_web_events
            UNION ALL SELECT 'null_customer', count(*) FROM stg_bookings
                      WHERE customer_id IS NULL
            UNION ALL SELECT 'negative_amount', count(*) FROM stg_bookings
                      WHERE booking_amount < 0
            UNION ALL SELECT 'late_booking', count(*) FROM stg_bookings
                      WHERE booking_timestamp >= experience_date::TIMESTAMP
            UNION ALL SELECT 'unknown_experience', count(*) FROM stg_bookings
                      WHERE experience_id NOT IN (SELECT experience_id FROM stg_experiences)
            UNION ALL SELECT 'out_of_order_session', count(DISTINCT session_id)
                      FROM ({_STEPS}) WHERE event_timestamp <= previous_timestamp
                                         OR stage < previous_stage""",
        "batch_gate": " UNION ALL ".join([
            _violations("'bookings' AS \"table\"", {
                "booking_amount >= 0": "raw_bookings WHERE NOT coalesce(booking_amount >= 0, false)",
            }),
            _repeats("'bookings'", "unique booking_id", "raw_bookings", "booking_id"),
            _violations("'availability'", {
                "available_capacity <= total_capacity":
                    "raw_availability WHERE NOT available_capacity <= total_capacity",
                "total_capacity >= 0": "raw_availability WHERE NOT total_capacity >= 0",
            }),
            _violations("'web_events'", {
                "known event_type": f"raw_web_events WHERE event_type NOT IN ({_STAGES})",
                "session_id present": "raw_web_events WHERE session_id IS NULL",
            }),
        ]),
        "contract_checks": " UNION ALL ".join([
            _violations("'suppliers' AS dataset", {
                "supplier_id present": "raw_suppliers WHERE supplier_id IS NULL",
                "commission_rate in 0..1":
                    "raw_suppliers WHERE NOT coalesce(commission_rate BETWEEN 0 AND 1, false)",
                "known supplier_status":
                    "raw_suppliers WHERE supplier_status NOT IN ('ACTIVE', 'INACTIVE')",
            }),
            _repeats("'suppliers'", "unique supplier_id", "raw_suppliers", "supplier_id"),
            _violations("'experiences'", {
                "experience_id present": "raw_experiences WHERE experience_id IS NULL",
                "base_price positive": "raw_experiences WHERE base_price <= 0",
                "capacity positive": "raw_experiences WHERE capacity <= 0",
                "rating in 1..5":
                    "raw_experiences WHERE NOT coalesce(rating BETWEEN 1 AND 5, false)",
                "known supplier_id": "(SELECT DISTINCT supplier_id FROM raw_experiences e WHERE "
                    "NOT EXISTS (SELECT 1 FROM raw_suppliers s "
                    "WHERE s.supplier_id = e.supplier_id))",
            }),
            _repeats("'experiences'", "unique experience_id", "raw_experiences",
                     "experience_id"),
            _violations("'customers'", {
                "customer_id present": "raw_customers WHERE customer_id IS NULL",
                "known customer_segment": "raw_customers WHERE customer_segment "
                    "NOT IN ('New', 'Repeat', 'VIP', 'Dormant')",
                "signup_date present": "raw_customers WHERE signup_date IS NULL",
            }),
            _repeats("'customers'", "unique customer_id", "raw_customers", "customer_id"),
        ]),
        "invariants": " UNION ALL ".join([
            *invariant_rows,
            """SELECT 'booking day has inventory', count(*) FROM stg_bookings
               WHERE (experience_id, experience_date) NOT IN
                     (SELECT (experience_id, experience_date) FROM stg_availability)""",
            """SELECT 'available capacity in bounds', count(*) FROM stg_availability
               WHERE NOT available_capacity BETWEEN 0 AND total_capacity""",
        ]),
        "raw_row_counts": " UNION ALL ".join(
            f"SELECT '{t}' AS \"table\", count(*) AS n_rows FROM raw_{t}" for t in raw_tables
        ),
        "null_counts": "SELECT " + ", ".join(
            f"count(*) FILTER ({c} IS NULL) AS {c}" for c in booking_columns
        ) + " FROM raw_bookings",
        "next_booking_number": """
            SELECT coalesce(max(try_cast(substr(booking_id, 2) AS BIGINT)), 90000) + 1
                   AS next_number
            FROM raw_bookings""",
    }


_NUMERIC = (
    "capacity rating base_price avg_price bookings_prev_1d bookings_prev_7d_avg "
    "bookings_prev_28d_avg utilization_prev_7d_avg cancellation_rate_prev_28d_avg "
    "days_of_prior_history is_weekend"
).split()


def _cells(rows: str) -> str:
    """The matrix of ``rows`` as (r, f, x) without the zeros of the categories."""
    numbers = [f"SELECT r, '{c}' AS f, coalesce({c}::DOUBLE, 0) AS x FROM {rows}" for c in _NUMERIC]
    categories = [
        f"SELECT r, '{c}=' || {c} AS f, 1::DOUBLE AS x FROM {rows} WHERE {c} IS NOT NULL"
        for c in ("city", "category", "day_name", "month", "quarter")
    ]
    return f"SELECT * FROM ({' UNION ALL '.join([*numbers, *categories])})"


def _ridge(result: str, scored: str) -> str:
    """``result`` over ``weights`` (f, w) of a ridge with penalty 1 and ``predicted`` (the rows of ``scored``, p).

    The normal equations of the centred columns are solved by elimination, one column a step: with
    the penalty their matrix is positive definite, so no step divides by zero.
    """
    return f"""
        SELECT * FROM (WITH RECURSIVE
            train AS MATERIALIZED (
                SELECT row_number() OVER () AS r, * FROM ({_TRAINING}) WHERE feature_date <= {_LAST_DAY}),
            cells AS MATERIALIZED (
                {_cells('train')} UNION ALL SELECT r, '~label', target_bookings::DOUBLE FROM train),
            means AS MATERIALIZED (
                SELECT f, sum(x) / (SELECT count(*) FROM train) AS mean, row_number() OVER (ORDER BY f) AS i
                FROM cells GROUP BY f),
            products AS MATERIALIZED (
                SELECT a.f AS f, b.f AS g, sum(a.x * b.x) AS s FROM cells a JOIN cells b USING (r) GROUP BY 1, 2),
            equations AS (
                SELECT list(line ORDER BY i) AS m FROM (
                    SELECT a.i, list(coalesce(s, 0) - (SELECT count(*) FROM train) * a.mean * b.mean
                                     + (a.i = b.i)::INT ORDER BY b.i) AS line
                    FROM means a CROSS JOIN means b LEFT JOIN products p ON p.f = a.f AND p.g = b.f
                    WHERE a.f <> '~label' GROUP BY a.i)),
            solved(k, m) AS (
                SELECT 1, m FROM equations
                UNION ALL
                SELECT k + 1, list_transform(m, lambda line, i: CASE
                    WHEN i = k THEN list_transform(line, lambda x: x / line[k])
                    ELSE list_transform(line, lambda x, j: x - line[k] / top[k] * top[j]) END)
                FROM (SELECT k, m, m[k] AS top FROM solved WHERE k <= len(m))),
            slopes AS MATERIALIZED (
                SELECT f, mean, m[i][-1] AS w FROM means, (SELECT m FROM solved ORDER BY k DESC LIMIT 1)
                WHERE f <> '~label'),
            weights AS MATERIALIZED (
                SELECT f, w FROM slopes
                UNION ALL
                SELECT 'intercept', (SELECT mean FROM means WHERE f = '~label') - sum(mean * w) FROM slopes),
            scored AS MATERIALIZED (SELECT row_number() OVER () AS r, * FROM ({scored})),
            predicted AS (
                SELECT scored.*, greatest(p, 0) AS p
                FROM scored JOIN (
                    SELECT r, sum(x * w) + (SELECT w FROM weights WHERE f = 'intercept') AS p
                    FROM ({_cells('scored')}) JOIN weights USING (f) GROUP BY r) USING (r))
            {result})"""


def _forecasting() -> dict[str, str]:
    numeric = _NUMERIC
    window = (
        "avg({c}) OVER (PARTITION BY experience_id ORDER BY feature_date "
        "ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    )
    day = "(SELECT max(feature_date) + 1 FROM ml_base_features)"
    test = f"SELECT * FROM ({_TRAINING}) WHERE feature_date > {_LAST_DAY}"
    baselines = " UNION ALL ".join([
        _baseline("last_value", "bookings_prev_1d"),
        _baseline("mean_7d", "bookings_prev_7d_avg"),
        _baseline("mean_28d", "bookings_prev_28d_avg"),
    ])
    next_day = f"""
            SELECT * REPLACE (round(rating, 8) AS rating) FROM (
                SELECT *, lag(target_bookings) OVER w AS bookings_prev_1d,
                       round({window.format(c="target_bookings", n=7)}, 8)
                           AS bookings_prev_7d_avg,
                       round({window.format(c="target_bookings", n=28)}, 8)
                           AS bookings_prev_28d_avg,
                       round({window.format(c="target_utilization_rate", n=7)}, 8)
                           AS utilization_prev_7d_avg,
                       round({window.format(c="target_cancellation_rate", n=28)}, 8)
                           AS cancellation_rate_prev_28d_avg,
                       (row_number() OVER w - 1)::INT AS days_of_prior_history
                FROM (
                    SELECT * FROM ml_base_features
                    UNION ALL
                    SELECT experience_id, date_day, day_of_week, is_weekend, month, quarter,
                           day_name, city, category, capacity, rating, base_price,
                           round(base_price * {_SEASON.format(day="date_day")}
                                 * (CASE WHEN is_weekend THEN 1.15 ELSE 1 END)::DOUBLE, 2),
                           NULL, NULL, NULL, NULL
                    FROM dim_experience, dim_date WHERE active_flag AND date_day = {day})
                WINDOW w AS (PARTITION BY experience_id ORDER BY feature_date))
            WHERE feature_date = {day}"""
    return {
        "chronological_split": f"""
            SELECT CASE WHEN feature_date <= {_LAST_DAY} THEN 'train' ELSE 'test' END AS part,
                   count(*) AS n_rows, min(feature_date) AS first_day,
                   max(feature_date) AS last_day
            FROM ({_TRAINING}) GROUP BY 1""",
        "gate_history": f"""
            SELECT r.*, (SELECT count(*) FROM ({_TRAINING}) WHERE feature_date > {_LAST_DAY}) AS n_test_rows
            FROM (VALUES ('run-1', 'ridge', false, true, true), ('run-2', 'ridge', true, true, true),
                         ('run-3', 'ridge', true, false, true))
                 AS r(run, candidate, had_champion, promoted, loaded_agrees)""",
        "baseline_scores": baselines,
        "imputed_feature_counts": "SELECT " + ", ".join(
            f"count(*) FILTER ({c} IS NULL) AS {c}" for c in numeric
        ) + f" FROM ({_TRAINING})",
        "next_day_features": next_day,
        "ridge_leaderboard": _ridge(f"""
            SELECT 'ridge' AS model, round(avg(abs(target_bookings - p)), 3) AS mae,
                   round(sqrt(avg((target_bookings - p) ** 2)), 3) AS rmse, count(*) AS n
            FROM predicted UNION ALL SELECT model, mae, rmse, n FROM ({baselines})""", test),
        "ridge_weights": _ridge("SELECT f AS feature, round(w, 6) AS weight FROM weights", test),
        "next_day_forecast": _ridge(
            "SELECT experience_id, feature_date, round(p, 6) AS predicted_bookings FROM predicted",
            next_day.replace(", 8)", ", 15)"),
        ),
    }


def _other() -> dict[str, str]:
    """Lookups, loads and streams.

    A stream has let out everything before its watermark once its input is used up.
    """
    prior = _PRIOR.replace("int_booking_details", "stg_bookings").replace(
        "experience_category AS category,", ""
    )
    return {
        "active_experiences": """
            SELECT experience_id, experience_name, city, category, capacity,
                   round(rating, 4) AS rating, base_price
            FROM dim_experience WHERE active_flag""",
        "customer_ids": "SELECT customer_id FROM dim_customer",
        "customer_cancellation_counts": """
            SELECT c.customer_id, count(booking_id) AS cancellation_count
            FROM dim_customer c LEFT JOIN fact_bookings b
              ON c.customer_id = b.customer_id AND booking_status IN ('CANCELLED', 'REFUNDED')
            GROUP BY 1""",
        "purchase_sessions": """
            SELECT count(DISTINCT session_id) AS purchase_sessions FROM fact_web_events
            WHERE event_type = 'PURCHASE'""",
        "next_event_number": """
            SELECT coalesce(max(try_cast(substr(event_id, 4) AS BIGINT)), 1000000) + 1
                   AS next_number
            FROM raw_web_events""",
        "stream_prior_cancellations": f"""
            SELECT booking_id, customer_id, booking_status, prior_cancellations
            FROM ({prior})""",
        "stream_enriched_bookings": """
            SELECT booking_id,
                   e.* EXCLUDE (active_flag) REPLACE (round(base_price, 4) AS base_price, round(rating, 4) AS rating),
                   supplier_name, supplier_type, round(commission_rate, 4) AS commission_rate, supplier_status
            FROM stg_bookings b JOIN stg_experiences e ON b.experience_id = e.experience_id
            JOIN stg_suppliers s ON e.supplier_id = s.supplier_id""",
        "stream_late_bookings": """
            SELECT booking_id, booking_timestamp, experience_date FROM stg_bookings
            WHERE booking_timestamp >= experience_date::TIMESTAMP""",
        "landed_events": "SELECT * FROM raw_web_events",
        "load_reconciliation": """
            SELECT event_timestamp::DATE AS dt, count(*) AS file_rows, count(*) AS loaded_rows,
                   0::BIGINT AS rejected_rows, true AS complete
            FROM raw_web_events GROUP BY 1""",
        "repeated_loads": """
            SELECT event_timestamp::DATE AS dt, count(*) AS file_rows, count(*) AS loaded_rows,
                   0::BIGINT AS rejected_rows, true AS complete
            FROM raw_web_events GROUP BY 1""",
        "rejects_by_reason": f"""
            SELECT reason, count(*) AS n_rows FROM ({_DIRTY}) WHERE reason IS NOT NULL GROUP BY 1""",
        "rejects_by_day": f"""
            SELECT date_trunc('year', experience_date)::DATE AS dt, count(*) AS file_rows, count(*) FILTER (reason IS NULL) AS loaded_rows,
                   count(reason) AS rejected_rows, true AS complete
            FROM ({_DIRTY}) GROUP BY 1""",
        "bookings_after_rejects": f"""
            SELECT * EXCLUDE (n, copy, reason) REPLACE (
                       round(ticket_price, 4) AS ticket_price, round(discount_amount, 4) AS discount_amount,
                       round(booking_amount, 4) AS booking_amount, round(discount_pct, 4) AS discount_pct)
            FROM ({_DIRTY}) WHERE reason IS NULL""",
        "interleaved_loads": """
            SELECT load_order, event_timestamp::DATE AS dt, count(*) AS file_rows, count(*) AS loaded_rows,
                   0::BIGINT AS rejected_rows, true AS complete
            FROM raw_web_events
            CROSS JOIN (VALUES ('halves, then all'), ('a day, then overlapping'), ('late, all, whole')) AS o(load_order)
            GROUP BY 1, 2""",
        "quarantined_bookings": """
            SELECT booking_id, experience_id, 'unknown experience' AS quarantine_reason
            FROM stg_bookings
            WHERE experience_id NOT IN (SELECT experience_id FROM stg_experiences)""",
        "stream_dedup": "SELECT * FROM stg_web_events",
        "stream_dedup_counts": f"""
            SELECT * FROM (WITH dealt AS ({_DEALT}),
            batches AS (
                SELECT CASE WHEN part = 0 AND n % 50 = 7 THEN 3 ELSE part END AS batch,
                       CASE WHEN part = 0 AND n % 50 = 7 THEN 'late' ELSE 'kept' END AS kind FROM dealt
                UNION ALL
                SELECT part + 1, 'repeated' FROM dealt WHERE n % 10 = 0 AND part < 3)
            SELECT batch::BIGINT AS batch, count(*) AS read, count(*) FILTER (kind = 'kept') AS kept,
                   count(*) FILTER (kind = 'repeated') AS repeated, count(*) FILTER (kind = 'late') AS late
            FROM batches GROUP BY 1)""",
        "stream_dedup_late": f"""
            SELECT * EXCLUDE (n, part) FROM ({_DEALT}) WHERE part = 0 AND n % 50 = 7""",
        "stream_matched_purchases": f"""
            SELECT p.*, b.booking_id FROM {_PURCHASES} p JOIN stg_bookings b ON {_NEAR_BOOKING}""",
        "stream_unmatched_purchases": f"""
            SELECT p.* FROM {_PURCHASES} p
            WHERE NOT EXISTS (SELECT 1 FROM stg_bookings b WHERE {_NEAR_BOOKING})""",
        "purchase_matches": f"""
            SELECT * FROM (WITH purchase_log AS {_PURCHASES}, {_matching_rounds(4)},
            pairs AS ({" UNION ALL ".join(f"SELECT * FROM pairs{k}" for k in range(4))})
            SELECT event_id, booking_id, round(apart / 60000000, 4) AS minutes_apart, 'matched' AS status FROM pairs
            UNION ALL
            SELECT event_id, NULL, NULL, 'purchase only' FROM purchase_log
            WHERE event_id NOT IN (SELECT event_id FROM pairs)
            UNION ALL
            SELECT NULL, booking_id, NULL, 'booking only' FROM stg_bookings
            WHERE booking_id NOT IN (SELECT booking_id FROM pairs))""",
        "stream_daily_stages": """
            SELECT event_timestamp::DATE AS day, event_type,
                   count(DISTINCT session_id) AS sessions
            FROM raw_web_events WHERE session_id IS NOT NULL GROUP BY 1, 2""",
        "stream_daily_stages_approx": """
            SELECT event_timestamp::DATE AS day, event_type,
                   count(DISTINCT session_id) AS sessions, true AS near
            FROM raw_web_events WHERE session_id IS NOT NULL GROUP BY 1, 2""",
        "stream_sessions": f"""
            SELECT customer_id, count(*) AS events, min(event_timestamp) AS first_event_at,
                   max(event_timestamp) AS last_event_at,
                   max({_STAGE})::INT AS deepest_stage,
                   count(*) FILTER (event_type = 'PURCHASE') > 0 AS converted,
                   max(event_timestamp) + INTERVAL 30 MINUTE
                       >= (SELECT max(event_timestamp) FROM raw_web_events) AS is_open
            FROM (SELECT *, sum(starts) OVER (PARTITION BY customer_id ORDER BY event_timestamp)
                                AS visit
                  FROM (SELECT *, CASE WHEN event_timestamp - lag(event_timestamp) OVER (
                                           PARTITION BY customer_id ORDER BY event_timestamp)
                                       <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS starts
                        FROM raw_web_events))
            GROUP BY customer_id, visit""",
    }
