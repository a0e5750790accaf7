"""The same queries as SQL for DuckDB, written independently of the Spark plans.

Money is counted in whole units here (tenths of a cent, cents), and the dominant
category by rank, so both sides reach each number by different means.
"""

from __future__ import annotations

import re

from cartwright.operators import vocabulary as V

from .views import AS_OF, SEED

DAY = f"DATE '{AS_OF}'"


def money(cents: str, type_: str = "decimal(14,2)") -> str:
    return f"cast(cast({cents} as decimal(20,0)) * cast(0.01 as decimal(3,2)) as {type_})"


def ratio(units: str) -> str:
    return f"cast(cast({units} as decimal(20,0)) * cast(0.0001 as decimal(5,4)) as decimal(6,4))"


def half_up(num: str, den: str) -> str:
    return f"((2 * ({num}) + ({den})) // (2 * ({den})))"


# ---- views, each a named query; later ones use earlier ones --------------------

VIEWS: dict[str, str] = {}

VIEWS["v_orders"] = """
SELECT cast(o_orderkey as varchar) AS order_id,
       cast(CASE WHEN o_orderkey % 97 = 0 THEN -1 ELSE o_custkey END as bigint) AS user_id,
       o_orderdate + to_hours(cast(o_orderkey % 24 as integer)) AS order_timestamp,
       o_orderpriority AS payment_method,
       o_orderstatus AS shipping_provider,
       100 * (4 + o_orderkey % 19) AS ship_c
FROM orders"""

VIEWS["v_lines"] = """
SELECT cast(l_orderkey as varchar) AS order_id,
       cast(l_partkey as bigint) AS product_id,
       p_name AS title,
       CASE WHEN p_size % 10 = 0 THEN 'Unknown' ELSE p_type END AS category,
       cast(l_quantity as bigint) AS quantity,
       cast(round(l_extendedprice * 100) as bigint) // cast(l_quantity as bigint) AS price_m,
       cast(round(l_discount * 100) as bigint) AS pct
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey"""

# unit of amount_m: 1/1000; unit of discount_m: 1/100000
VIEWS["v_amounts"] = """
SELECT *, price_m * quantity AS amount_m, price_m * quantity * pct AS discount_m FROM v_lines"""

VIEWS["v_totals"] = """
SELECT order_id, category, sum(amount_m) AS amount_m FROM v_amounts GROUP BY ALL"""

VIEWS["v_dominant"] = """
SELECT order_id, category AS dominant_category FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY amount_m DESC, category) AS rn
  FROM v_totals) WHERE rn = 1"""

VIEWS["v_sums"] = """
SELECT order_id,
       cast((sum(amount_m) + 5) // 10 as bigint) AS gross_c,
       cast((sum(discount_m) + 500) // 1000 as bigint) AS disc_c,
       cast(sum(quantity) as bigint) AS items,
       count(DISTINCT product_id) AS uniq
FROM v_amounts GROUP BY order_id"""

VIEWS["v_facts"] = """
SELECT o.*, coalesce(gross_c, 0) AS gross_c, coalesce(disc_c, 0) AS disc_c,
       coalesce(items, 0) AS items, coalesce(uniq, 0) AS uniq,
       coalesce(dominant_category, 'Unknown') AS dominant_category
FROM v_orders o LEFT JOIN v_sums USING (order_id) LEFT JOIN v_dominant USING (order_id)"""

VIEWS["v_raw_users"] = """
SELECT cast(c_custkey as bigint) AS id,
       ' ' || split_part(c_name, '#', 1) || ' ' AS first_name,
       ' ' || split_part(c_name, '#', 2) || ' ' AS last_name,
       CASE WHEN c_custkey % 10 = 0 THEN ' ' || c_name || ' '
            WHEN c_custkey % 10 = 1 THEN c_name || '@x@' || c_mktsegment || '.Com'
            ELSE ' ' || chr(9) || c_name || '@' || c_mktsegment || '.Com' || ' ' END AS raw_email,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE n_name END AS raw_city,
       DATE '1996-01-01' + cast((c_custkey * 37) % 1460 as integer) AS day,
       c_custkey % 29 = 0 AS bad_day
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

VIEWS["v_users"] = f"""
SELECT id, first_name, last_name,
       lower(trim(raw_email, ' ' || chr(9))) AS email,
       CASE WHEN strpos(raw_email, '@') > 0
            THEN lower(trim(split_part(raw_email, '@', -1), ' ' || chr(9))) ELSE '' END
         AS email_domain,
       coalesce(raw_city, 'Unknown') AS city,
       CASE WHEN bad_day THEN {DAY} ELSE day END AS signup_date
FROM v_raw_users"""

VIEWS["v_enriched"] = f"""
SELECT order_id, id AS customer_id, first_name, last_name, email, email_domain, city,
       signup_date, order_timestamp, cast(order_timestamp as date) AS order_date,
       cast(hour(order_timestamp) as integer) AS order_hour, payment_method, shipping_provider,
       cast(items as integer) AS total_items,
       {money('gross_c')} AS gross_amount,
       {money('disc_c')} AS total_discount_amount,
       {money('gross_c - disc_c')} AS net_amount,
       {money('ship_c', 'decimal(10,2)')} AS shipping_cost,
       {money('gross_c - disc_c + ship_c')} AS final_amount,
       gross_c - disc_c + ship_c AS final_c,
       CASE WHEN gross_c > 0 THEN {ratio(half_up('disc_c * 10000', 'gross_c'))}
            ELSE cast(0 as decimal(6,4)) END AS discount_ratio,
       cast(2 * uniq + items as integer) AS order_complexity_score,
       dominant_category
FROM v_facts JOIN v_users ON user_id = id"""

ORDER_COLUMNS = """order_id, customer_id, order_timestamp, order_date, order_hour, gross_amount,
       total_discount_amount, net_amount, shipping_cost, final_amount, total_items,
       discount_ratio, order_complexity_score, dominant_category, payment_method,
       shipping_provider"""

ENRICHED_COLUMNS = """order_id, customer_id, first_name, last_name, email, email_domain, city,
       signup_date, order_timestamp, order_date, order_hour, payment_method, shipping_provider,
       total_items, gross_amount, total_discount_amount, net_amount, shipping_cost, final_amount,
       discount_ratio, order_complexity_score, dominant_category"""

CUSTOMER_COLUMNS = """customer_id, full_name, email, email_domain, city, customer_tenure_days,
       total_orders, total_spent, avg_order_value, lifetime_value_score, customer_segment"""


def order_view(source: str) -> str:
    return f"SELECT {ORDER_COLUMNS}, final_c FROM {source}"


def customer_view(source: str) -> str:
    """Customer table over an enriched source; every figure in whole units first."""
    return f"""
SELECT customer_id, full_name, email, email_domain, city, customer_tenure_days,
       cast(n as integer) AS total_orders, {money('spent_c')} AS total_spent,
       {money(half_up('spent_c', 'n'))} AS avg_order_value,
       {money('ltv_h', 'decimal(8,2)')} AS lifetime_value_score,
       CASE WHEN ltv_h >= 6000 THEN 'High' WHEN ltv_h >= 3000 THEN 'Medium' ELSE 'Low' END
         AS customer_segment
FROM (
  SELECT *, {half_up('points * 100', '365000000')} AS ltv_h FROM (
    SELECT *, least(spent_c * 365, 18250000000) + least(2 * n, 30) * 365000000
              + least(cast(customer_tenure_days as bigint) * 10000000, 7300000000) AS points FROM (
      SELECT customer_id, trim(max(first_name)) || ' ' || trim(max(last_name)) AS full_name,
             max(email) AS email, max(email_domain) AS email_domain, max(city) AS city,
             cast(greatest({DAY} - max(signup_date), 0) as integer) AS customer_tenure_days,
             count(DISTINCT order_id) AS n, cast(sum(final_c) as bigint) AS spent_c
      FROM {source} GROUP BY customer_id)))"""


VIEWS["v_order_table"] = order_view("v_enriched")
VIEWS["v_customer_table"] = customer_view("v_enriched")

# ---- the generator -------------------------------------------------------------


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def pick(digest: str, start: int, length: int, m: int | str) -> str:
    return f"(cast('0x' || substr({digest}, {start}, {length}) as bigint) % ({m}))"


def one_of(values: list[str], start: int, length: int, digest: str = "h") -> str:
    return f"{_list(values)}[{pick(digest, start, length, len(values))} + 1]"


def back_in_time(days: str, seconds: str) -> str:
    moment = f"{DAY} - to_days(cast({days} as integer)) + to_seconds({seconds})"
    return f"strftime({moment}, '%Y-%m-%dT%H:%M:%S')"


VIEWS["g_ids"] = "SELECT cast(o_orderkey + 1 as bigint) AS id FROM orders"

VIEWS["g_seed"] = """
SELECT cast(c_custkey as bigint) AS id,
       CASE WHEN c_custkey % 7 <> 0 THEN split_part(c_name, '#', 1) END AS first_name,
       CASE WHEN c_custkey % 6 = 0 THEN '' ELSE split_part(c_name, '#', 2) END AS last_name,
       CASE WHEN c_custkey % 5 <> 0 THEN split_part(c_name, '#', 2) || '@Shop.Example' END
         AS email,
       CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 11 = 1 THEN NULL
            ELSE cast(DATE '1996-01-01' + cast((c_custkey * 37) % 1460 as integer) as varchar)
            END AS created_at
FROM customer"""

VIEWS["g_pool"] = """
SELECT id, row_number() OVER (ORDER BY id) - 1 AS slot FROM (SELECT DISTINCT id FROM g_seed)"""

VIEWS["g_assigned"] = """
SELECT i.id, p.id AS user_id FROM g_ids i
JOIN g_pool p ON (i.id - 1) % (SELECT count(*) FROM g_pool) = p.slot"""


def _made_users(source: str) -> str:
    return f"""
SELECT id, {one_of(V.FIRST_NAMES, 1, 4)} AS first_name, {one_of(V.LAST_NAMES, 5, 4)} AS last_name,
       {one_of(V.EMAIL_DOMAINS, 9, 4)} AS domain, {pick('h', 13, 4, 999)} + 1 AS number,
       {one_of(V.CITIES, 17, 4)} AS city,
       {back_in_time(pick('h', 21, 4, 1431) + ' + 30', pick('h', 25, 8, 86400))} AS created_at
FROM (SELECT id, md5('{SEED}|user|' || id) AS h FROM {source})"""


VIEWS["g_made"] = _made_users("g_seed")

VIEWS["g_users"] = """
SELECT s.id, coalesce(nullif(s.first_name, ''), m.first_name) AS first_name,
       coalesce(nullif(s.last_name, ''), m.last_name) AS last_name,
       coalesce(nullif(s.email, ''), 'user' || s.id || '@gmail.com') AS email,
       m.city, coalesce(nullif(s.created_at, ''), m.created_at) AS created_at
FROM g_seed s JOIN g_made m USING (id)"""

VIEWS["g_draws"] = f"""
SELECT id, user_id, md5('{SEED}|order|' || id) AS h, md5('{SEED}|order-id|' || id) AS u
FROM g_assigned"""

_COURIER = pick("h", 1, 6, len(V.COURIERS))
_LOW = "[" + ", ".join(str(lo) for _, lo, _ in V.COURIERS) + "]"
_WIDTH = "[" + ", ".join(str((hi - lo) * 100 + 1) for _, lo, hi in V.COURIERS) + "]"

VIEWS["g_orders"] = f"""
SELECT id, user_id,
       concat_ws('-', substr(u, 1, 8), substr(u, 9, 4), substr(u, 13, 4), substr(u, 17, 4),
                 substr(u, 21, 12)) AS order_id,
       {back_in_time(pick('h', 7, 6, 366), pick('h', 13, 6, 86400))} AS order_timestamp,
       {one_of(V.PAYMENT_METHODS, 19, 6)} AS payment_method,
       {_list([n for n, _, _ in V.COURIERS])}[{_COURIER} + 1] AS shipping_provider,
       {_LOW}[{_COURIER} + 1] * 100 + {pick('h', 25, 6, f'{_WIDTH}[{_COURIER} + 1]')} AS ship_c,
       {pick('h', 31, 2, 4)} + 1 AS n_categories
FROM g_draws"""


def _catalogue() -> str:
    rows = []
    for category, items in V.CATALOGUE.items():
        for position, (title, low, high) in enumerate(items):
            rows.append(f"('{category}', {position}, '{title}', {low}, {high})")
    return f"SELECT * FROM (VALUES {', '.join(rows)}) t(category, position, title, low, high)"


VIEWS["g_catalogue"] = _catalogue()

VIEWS["g_tickets"] = f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY h) AS rn FROM (
    SELECT o.id, o.order_id, o.n_categories, c.category,
           md5('{SEED}|line|' || o.id || '|' || c.category) AS h
    FROM g_orders o CROSS JOIN (SELECT DISTINCT category FROM g_catalogue) c))
WHERE rn <= n_categories"""

VIEWS["g_lines"] = f"""
SELECT t.order_id, cast({pick('t.h', 27, 6, 9000)} + 1000 as bigint) AS product_id, c.title,
       t.category,
       c.low * 100 + {pick('t.h', 13, 6, '(c.high - c.low) * 100 + 1')} AS price_c,
       cast({pick('t.h', 19, 4, 5)} + 1 as integer) AS quantity,
       {pick('t.h', 23, 4, 26)} AS pct
FROM g_tickets t
JOIN g_catalogue c ON t.category = c.category AND {pick('t.h', 9, 4, 5)} = c.position"""

VIEWS["g_sums"] = """
SELECT order_id, sum(price_c * quantity) AS gross_c,
       (sum(price_c * quantity * pct) + 50) // 100 AS disc_c,
       sum(quantity) AS items, count(DISTINCT product_id) AS uniq
FROM g_lines GROUP BY order_id"""

VIEWS["g_dominant"] = """
SELECT order_id, category AS dominant_category FROM (
  SELECT order_id, category,
         row_number() OVER (PARTITION BY order_id ORDER BY amount_c DESC, category) AS rn
  FROM (SELECT order_id, category, sum(price_c * quantity) AS amount_c
        FROM g_lines GROUP BY ALL)) WHERE rn = 1"""

VIEWS["g_enriched"] = f"""
SELECT order_id, u.id AS customer_id, first_name, last_name, lower(email) AS email,
       split_part(lower(email), '@', -1) AS email_domain, city,
       cast(substr(created_at, 1, 10) as date) AS signup_date,
       cast(o.order_timestamp as timestamp) AS order_timestamp,
       cast(cast(o.order_timestamp as timestamp) as date) AS order_date,
       cast(hour(cast(o.order_timestamp as timestamp)) as integer) AS order_hour,
       payment_method, shipping_provider,
       cast(items as integer) AS total_items,
       {money('gross_c')} AS gross_amount,
       {money('disc_c')} AS total_discount_amount,
       {money('gross_c - disc_c')} AS net_amount,
       {money('ship_c', 'decimal(10,2)')} AS shipping_cost,
       {money('gross_c - disc_c + ship_c')} AS final_amount,
       gross_c - disc_c + ship_c AS final_c,
       {ratio(half_up('disc_c * 10000', 'gross_c'))} AS discount_ratio,
       cast(2 * uniq + items as integer) AS order_complexity_score,
       dominant_category
FROM g_orders o JOIN g_users u ON o.user_id = u.id
JOIN g_sums USING (order_id) JOIN g_dominant USING (order_id)"""

VIEWS["g_order_table"] = order_view("g_enriched")
VIEWS["g_customer_table"] = customer_view("g_enriched")

# The same over the order ids 1..n, as the jobs draw them.
for _name in [n for n in VIEWS if n.startswith("g_")]:
    VIEWS["r_" + _name[2:]] = re.sub(r"\bg_([a-z_]+)\b", r"r_\1", VIEWS[_name])
VIEWS["r_ids"] = "SELECT cast(row_number() OVER () as bigint) AS id FROM orders"


def sql(body: str) -> str:
    """``body`` with the views it needs, in the order of their definition."""
    needed: set[str] = set()
    stack = [body]
    while stack:
        for name in re.findall(r"\b[vgr]_[a-z_]+\b", stack.pop()):
            if name in VIEWS and name not in needed:
                needed.add(name)
                stack.append(VIEWS[name])
    # Views of the generator are read more than once by later ones: compute each once.
    ctes = [
        f"{n} AS {'MATERIALIZED ' if n[0] in 'gr' else ''}({q})"
        for n, q in VIEWS.items()
        if n in needed
    ]
    return (f"WITH {', '.join(ctes)}\n" if ctes else "") + body
