"""Equivalent DuckDB SQL for every registered query.

The generated tables are visible to DuckDB as views of the same names. Each
query is ``WITH <the views it needs> <job SQL>``; view texts mirror
``casebook.sources.views`` and job texts mirror the job functions, with
explicit casts where DuckDB's result types differ from Spark's (HUGEINT
sums, DOUBLE decimal division) and with exact integer rounding where a
rounded ratio is reported.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}
JOBS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    VIEWS[name] = sql
    VIEW_DEPS[name] = deps


VIEW_DEPS: dict[str, tuple[str, ...]] = {}


def job(name: str, uses: tuple[str, ...], sql: str) -> None:
    JOBS[name] = (uses, sql)


def exact_round(num: str, den: str, scale: int = 2) -> str:
    """round(num/den, scale) half away from zero for integral num, den > 0, as DECIMAL(38,scale)."""
    f = 10 ** scale
    unit = "0." + "0" * (scale - 1) + "1"
    q = f"((2 * abs({num}) * {f} + ({den})) // (2 * ({den})))"
    return (
        f"CAST(CAST(CASE WHEN ({num}) < 0 THEN -{q} ELSE {q} END AS DECIMAL(38,0)) * {unit} "
        f"AS DECIMAL(38,{scale}))"
    )


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in VIEW_DEPS.get(n, ()):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def sql_for(name: str) -> str:
    uses, body = JOBS[name]
    ctes = [f"{v} AS (\n{VIEWS[v]}\n)" for v in _closure(uses)]
    body = body.strip()
    if not ctes:
        return body
    if body[:4].upper() == "WITH":
        # merge the job's own CTEs after the views it reads
        return "WITH " + ",\n".join(ctes) + ",\n" + body[4:].lstrip()
    return "WITH " + ",\n".join(ctes) + "\n" + body


def all_sql() -> dict[str, str]:
    return {name: sql_for(name) for name in JOBS}


# ---------------------------------------------------------------------------
# Views
# ---------------------------------------------------------------------------

view("sales_v", """
SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS order_date, l.l_partkey AS product_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")

view("menu_v", """
SELECT p_partkey AS product_id, p_brand AS product_name, p_type AS product_type,
       CAST(p_retailprice AS DECIMAL(12,2)) AS price
FROM part""")

# ---------------------------------------------------------------------------
# Jobs
# ---------------------------------------------------------------------------

job("spend_per_customer", ("sales_v", "menu_v"), """
SELECT s.customer_id, CAST(SUM(m.price) AS DECIMAL(22,2)) AS amount_spent
FROM sales_v s JOIN menu_v m ON s.product_id = m.product_id
GROUP BY s.customer_id""")


# ---------------------------------------------------------------------------
# More views
# ---------------------------------------------------------------------------

view("members_v", """
SELECT o_custkey AS customer_id, MIN(CAST(o_orderdate AS DATE)) AS join_date
FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey""")

view("raw_orders_v", """
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, l.l_partkey AS pizza_id,
       CASE l.l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN 'null' WHEN 2 THEN NULL
            ELSE CAST(CAST(l.l_quantity AS INTEGER) % 12 + 1 AS VARCHAR) END AS exclusions,
       CASE CAST(l.l_quantity AS INTEGER) % 3 WHEN 0 THEN 'null'
            WHEN 1 THEN concat(CAST(l.l_linenumber AS VARCHAR), ', ', CAST(l.l_linenumber + 5 AS VARCHAR))
            ELSE '' END AS extras,
       o.o_orderdate AS order_time
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")

view("raw_deliveries_v", """
SELECT o_orderkey AS order_id, o_custkey % 100 AS runner_id,
       CASE WHEN o_orderkey % 10 = 0 THEN 'null'
            ELSE CAST(o_orderdate + to_minutes(CAST(o_orderkey % 90 + 5 AS INTEGER)) AS VARCHAR) END AS pickup_time,
       CASE WHEN o_orderkey % 10 = 0 THEN 'null'
            WHEN o_orderkey % 3 = 0 THEN concat(CAST(o_orderkey % 30 + 1 AS VARCHAR), 'km')
            WHEN o_orderkey % 3 = 1 THEN concat(CAST(o_orderkey % 30 + 1 AS VARCHAR), '.4 km')
            ELSE CAST(o_orderkey % 30 + 1 AS VARCHAR) END AS distance,
       CASE WHEN o_orderkey % 10 = 0 THEN 'null'
            WHEN o_orderkey % 3 = 0 THEN concat(CAST(o_orderkey % 40 + 10 AS VARCHAR), ' minutes')
            WHEN o_orderkey % 3 = 1 THEN concat(CAST(o_orderkey % 40 + 10 AS VARCHAR), 'mins')
            ELSE CAST(o_orderkey % 40 + 10 AS VARCHAR) END AS duration,
       CASE o_orderkey % 10 WHEN 0 THEN 'Customer Cancellation' WHEN 1 THEN NULL WHEN 2 THEN ''
            WHEN 3 THEN 'NaN' ELSE 'null' END AS cancellation
FROM orders""")

view("clean_orders_v", """
SELECT order_id, customer_id, pizza_id,
       CASE WHEN exclusions IN ('', 'null') THEN NULL ELSE exclusions END AS exclusions,
       CASE WHEN extras IN ('', 'null', 'NaN') THEN NULL ELSE extras END AS extras,
       order_time
FROM raw_orders_v""", ("raw_orders_v",))

view("clean_deliveries_v", """
SELECT order_id, runner_id,
       CAST(CASE WHEN pickup_time IN ('null') THEN NULL ELSE pickup_time END AS TIMESTAMP) AS pickup_time,
       CAST(trim(regexp_replace(CASE WHEN distance IN ('null') THEN NULL ELSE distance END, '[a-z]+', '', 'g'))
            AS DECIMAL(10,2)) AS distance,
       CAST(trim(regexp_replace(CASE WHEN duration IN ('null') THEN NULL ELSE duration END, '[a-z]+', '', 'g'))
            AS DECIMAL(10,2)) AS duration,
       CASE WHEN cancellation IN ('null', 'NaN', '') THEN NULL ELSE cancellation END AS cancellation
FROM raw_deliveries_v""", ("raw_deliveries_v",))

view("pizza_names_v", """
SELECT p_partkey AS pizza_id, p_brand AS pizza_name FROM part""")

view("toppings_v", """
SELECT CAST(row_number() OVER (ORDER BY topping_name) AS INTEGER) AS topping_id, topping_name
FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS topping_name FROM part WHERE p_name IS NOT NULL)""")

view("recipe_v", """
SELECT u.p_partkey AS pizza_id, string_agg(CAST(t.topping_id AS VARCHAR), ', ' ORDER BY u.pos) AS toppings
FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w,
             unnest(generate_series(1, len(string_split(p_name, ' ')))) AS pos
      FROM part) u
JOIN toppings_v t ON t.topping_name = u.w
GROUP BY u.p_partkey""", ("toppings_v",))

view("subs_v", """
SELECT user_id AS customer_id,
       CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 2
                       WHEN 'purchase' THEN 3 WHEN 'error' THEN 4 END AS plan_id,
       ts AS start_date, event_id
FROM events""")

view("next_v", """
SELECT *, LEAD(plan_id) OVER (PARTITION BY customer_id ORDER BY start_date, event_id) AS next_plan,
          LEAD(start_date) OVER (PARTITION BY customer_id ORDER BY start_date, event_id) AS next_date
FROM subs_v""", ("subs_v",))

view("total_v", """
SELECT COUNT(DISTINCT customer_id) AS num FROM subs_v""", ("subs_v",))

view("timeline_v", """
SELECT o_custkey AS customer_id,
       CASE WHEN o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 2
            WHEN o_orderstatus = 'O' THEN 1 WHEN o_orderstatus = 'F' THEN 3
            WHEN o_orderstatus = 'P' THEN 4 END AS plan_id,
       CAST(o_orderdate AS DATE) AS start_date, o_orderkey AS order_key
FROM orders""")

view("plans_v", """
SELECT plan_id, plan_name, CAST(price AS DECIMAL(5,2)) AS price
FROM (VALUES (0, 'trial', 0), (1, 'basic monthly', 9.90), (2, 'pro monthly', 19.90),
             (3, 'pro annual', 199), (4, 'churn', NULL)) AS p(plan_id, plan_name, price)""")

view("days_v", """
SELECT date_diff('day', CAST(j.d AS DATE), CAST(p.d AS DATE)) AS days
FROM (SELECT customer_id, MIN(start_date) AS d FROM subs_v WHERE plan_id = 0 GROUP BY customer_id) j
JOIN (SELECT customer_id, MIN(start_date) AS d FROM subs_v WHERE plan_id = 3 GROUP BY customer_id) p
  ON j.customer_id = p.customer_id""", ("subs_v",))

SOLD = "sales_v s JOIN menu_v m ON s.product_id = m.product_id"
MEMBER_SOLD = ("sales_v s JOIN members_v mb ON s.customer_id = mb.customer_id "
               "JOIN menu_v m ON s.product_id = m.product_id")
DELIVERED = "clean_orders_v c JOIN clean_deliveries_v d ON c.order_id = d.order_id"
MINUTES = ("(CAST((date_part('hour', d.pickup_time - c.order_time) % 24) * 60 "
           "+ date_part('minute', d.pickup_time - c.order_time) AS DOUBLE) "
           "+ (date_part('microseconds', d.pickup_time - c.order_time) / 1000000.0) / 60.0)")
PREMIUM = "CASE WHEN m.product_type = 'ECONOMY' THEN 12 ELSE 10 END"
PRICED = "clean_orders_v c JOIN menu_v m ON c.pizza_id = m.product_id"


def _pct(part: str, total: str) -> str:
    return f"CAST({part} AS DOUBLE) / CAST({total} AS DOUBLE) * 100"


def _round_pct(part: str, total: str) -> str:
    return f"CAST(round(CAST({_pct(part, total)} AS DECIMAL(18,6)), 2) AS DECIMAL(18,2))"


# --- loyalty ------------------------------------------------------------------

job("visit_days", ("sales_v",), """
SELECT customer_id, COUNT(DISTINCT order_date) AS days_visited FROM sales_v GROUP BY customer_id""")

job("first_item", ("sales_v", "menu_v"), f"""
SELECT customer_id, product_name FROM (
  SELECT s.customer_id, m.product_name, RANK() OVER (PARTITION BY s.customer_id ORDER BY s.order_date) AS r
  FROM {SOLD}) WHERE r = 1""")

job("top_item", ("sales_v", "menu_v"), f"""
SELECT m.product_name, COUNT(*) AS times_purchased FROM {SOLD}
GROUP BY m.product_name ORDER BY times_purchased DESC, m.product_name LIMIT 1""")

job("favourite_item", ("sales_v", "menu_v"), f"""
SELECT customer_id, product_name FROM (
  SELECT customer_id, product_name, RANK() OVER (PARTITION BY customer_id ORDER BY num DESC) AS r
  FROM (SELECT s.customer_id, m.product_name, COUNT(*) AS num FROM {SOLD} GROUP BY s.customer_id, m.product_name))
WHERE r = 1""")

job("first_after_join", ("sales_v", "menu_v", "members_v"), f"""
SELECT customer_id, product_name FROM (
  SELECT s.customer_id, m.product_name, RANK() OVER (PARTITION BY s.customer_id ORDER BY s.order_date) AS r
  FROM {MEMBER_SOLD} WHERE s.order_date >= mb.join_date) WHERE r = 1""")

job("last_before_join", ("sales_v", "menu_v", "members_v"), f"""
SELECT customer_id, product_name FROM (
  SELECT s.customer_id, m.product_name, RANK() OVER (PARTITION BY s.customer_id ORDER BY s.order_date DESC) AS r
  FROM {MEMBER_SOLD} WHERE s.order_date < mb.join_date) WHERE r = 1""")

job("pre_join_totals", ("sales_v", "menu_v", "members_v"), f"""
SELECT s.customer_id, COUNT(*) AS total_items, CAST(SUM(m.price) AS DECIMAL(22,2)) AS amount
FROM {MEMBER_SOLD} WHERE s.order_date < mb.join_date GROUP BY s.customer_id""")

job("points", ("sales_v", "menu_v"), f"""
SELECT s.customer_id,
       CAST(SUM(CASE WHEN m.product_name = 'Brand#1' THEN 20 * m.price ELSE 10 * m.price END) AS DECIMAL(25,2)) AS points
FROM {SOLD} GROUP BY s.customer_id""")

job("bonus_window_points", ("sales_v", "menu_v", "members_v"), f"""
SELECT s.customer_id,
       CAST(SUM(CASE WHEN m.product_name = 'Brand#1' THEN 20 * m.price
                     WHEN s.order_date BETWEEN mb.join_date AND mb.join_date + 7 THEN 20 * m.price
                     ELSE 10 * m.price END) AS DECIMAL(25,2)) AS points
FROM {MEMBER_SOLD} WHERE s.order_date <= DATE '1999-01-31' GROUP BY s.customer_id""")

JOIN_ALL = f"""
SELECT s.customer_id, s.order_date, m.product_name, m.price,
       CASE WHEN s.order_date >= mb.join_date THEN 'Y' ELSE 'N' END AS member
FROM {SOLD} LEFT JOIN members_v mb ON s.customer_id = mb.customer_id"""

job("join_all", ("sales_v", "menu_v", "members_v"), JOIN_ALL)

job("rank_members", ("sales_v", "menu_v", "members_v"), f"""
SELECT *, CASE WHEN member = 'Y'
               THEN CAST(RANK() OVER (PARTITION BY customer_id, member ORDER BY order_date) AS INTEGER) END AS ranking
FROM ({JOIN_ALL})""")

# --- cleaning and order metrics -----------------------------------------------

job("clean_orders", ("clean_orders_v",), "SELECT * FROM clean_orders_v")
job("clean_deliveries", ("clean_deliveries_v",), "SELECT * FROM clean_deliveries_v")
job("item_count", ("clean_orders_v",), "SELECT COUNT(*) AS items_ordered FROM clean_orders_v")
job("order_count", ("clean_orders_v",), "SELECT COUNT(DISTINCT order_id) AS unique_orders FROM clean_orders_v")

job("success_per_runner", ("clean_deliveries_v",), """
SELECT runner_id, COUNT(*) AS successful_orders FROM clean_deliveries_v
WHERE cancellation IS NULL GROUP BY runner_id ORDER BY runner_id""")

job("delivered_per_type", ("clean_orders_v", "clean_deliveries_v"), f"""
SELECT c.pizza_id, COUNT(*) AS delivered FROM {DELIVERED} WHERE d.cancellation IS NULL GROUP BY c.pizza_id""")

_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
job("type_pivot", ("sales_v", "menu_v"), "SELECT s.customer_id, " + ", ".join(
    f"CAST(SUM(CASE WHEN m.product_type = '{v}' THEN 1 ELSE 0 END) AS BIGINT) AS \"{v}\"" for v in _TYPES
) + ", count_if(coalesce(m.product_type NOT IN (" + ", ".join(f"'{v}'" for v in _TYPES) + f"), true)) AS \"OTHER\" FROM {SOLD} GROUP BY s.customer_id ORDER BY s.customer_id")

job("order_sizes", ("clean_orders_v",), """
SELECT order_id, COUNT(*) AS items_in_order FROM clean_orders_v GROUP BY order_id ORDER BY items_in_order DESC""")

job("changed_vs_plain", ("clean_orders_v", "clean_deliveries_v"), f"""
SELECT c.customer_id,
       CAST(SUM(CASE WHEN c.exclusions IS NOT NULL OR c.extras IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS changed_items,
       CAST(SUM(CASE WHEN c.exclusions IS NULL AND c.extras IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unchanged_items
FROM {DELIVERED} WHERE d.cancellation IS NULL GROUP BY c.customer_id""")

job("both_changes", ("clean_orders_v", "clean_deliveries_v"), f"""
SELECT COUNT(*) AS items_with_both FROM {DELIVERED}
WHERE d.cancellation IS NULL AND (c.extras IS NOT NULL AND c.exclusions IS NOT NULL)""")

job("hourly_volume", (), """
SELECT CAST(hour(ts) AS INTEGER) AS hour, COUNT(*) AS orders_per_hour FROM events GROUP BY 1 ORDER BY 1""")

job("weekday_volume", ("clean_orders_v",), """
SELECT dayname(order_time) AS day, COUNT(*) AS orders_per_day FROM clean_orders_v GROUP BY 1 ORDER BY 1""")

job("weekly_signups", (), """
SELECT CAST((day(CAST(ts AS DATE)) + 6) // 7 AS VARCHAR) AS week, COUNT(*) AS signups FROM events
WHERE event_type = 'signup' GROUP BY 1 ORDER BY 1""")

# --- runner performance -------------------------------------------------------

job("pickup_minutes", ("clean_orders_v", "clean_deliveries_v"), f"""
SELECT d.runner_id, AVG({MINUTES}) AS average_minutes FROM {DELIVERED} GROUP BY d.runner_id ORDER BY d.runner_id""")

job("prep_by_order", ("clean_orders_v", "clean_deliveries_v"), f"""
SELECT c.order_id, COUNT(c.pizza_id) AS items, AVG({MINUTES}) AS prep_minutes
FROM {DELIVERED} GROUP BY c.order_id ORDER BY c.order_id""")

job("mean_distance", ("clean_orders_v", "clean_deliveries_v"), f"""
SELECT c.customer_id,
       CASE WHEN COUNT(d.distance) > 0
            THEN {exact_round("SUM(CAST(d.distance * 100 AS BIGINT))", "COUNT(d.distance) * 100")} END AS average_distance
FROM {DELIVERED} GROUP BY c.customer_id ORDER BY c.customer_id""")

job("duration_range", ("clean_deliveries_v",), """
SELECT MAX(duration) - MIN(duration) AS duration_range FROM clean_deliveries_v""")

# order_id is the orders key: each (runner, order) group holds one delivery,
# so the mean speed is that delivery's 60 * distance / duration.
job("delivery_speed", ("clean_deliveries_v",), f"""
SELECT runner_id, order_id,
       {exact_round("60 * CAST(ANY_VALUE(distance) * 100 AS BIGINT)", "CAST(ANY_VALUE(duration) * 100 AS BIGINT)")} AS average_speed
FROM clean_deliveries_v WHERE cancellation IS NULL GROUP BY runner_id, order_id ORDER BY runner_id""")

job("success_percent", ("clean_deliveries_v",), f"""
SELECT runner_id, COUNT(order_id) AS total_orders,
       CAST(SUM(CASE WHEN cancellation IS NOT NULL THEN 0 ELSE 1 END) AS BIGINT) AS success_orders,
       CAST(SUM(CASE WHEN cancellation IS NOT NULL THEN 0 ELSE 1 END) AS DOUBLE) / COUNT(order_id) * 100 AS success_percent
FROM clean_deliveries_v GROUP BY runner_id ORDER BY runner_id""")

# --- ingredients --------------------------------------------------------------

STANDARD = """
SELECT r.pizza_id, n.pizza_name, string_agg(t.topping_name, ', ' ORDER BY t.topping_name) AS standard_ingredients
FROM (SELECT pizza_id, CAST(unnest(string_split(toppings, ', ')) AS INTEGER) AS topping_id FROM {recipes}) r
JOIN toppings_v t ON r.topping_id = t.topping_id
JOIN {names} n ON r.pizza_id = n.pizza_id
GROUP BY r.pizza_id, n.pizza_name ORDER BY r.pizza_id"""

job("standard_ingredients", ("recipe_v", "toppings_v", "pizza_names_v"),
    STANDARD.format(recipes="recipe_v", names="pizza_names_v"))


def _top_listed(col: str, out: str) -> str:
    # The most frequent id by comparing with the greatest count, over a histogram of each list.
    return f"""
WITH ids AS (SELECT unnest(string_split({col}, ', '))::INTEGER AS id FROM clean_orders_v),
counts AS (SELECT id, COUNT(*) AS n FROM ids SEMI JOIN toppings_v ON id = topping_id GROUP BY id)
SELECT id AS {out}, (SELECT topping_name FROM toppings_v WHERE topping_id = id) AS topping_name
FROM counts WHERE n >= ALL (SELECT n FROM counts)"""


job("top_extra", ("clean_orders_v", "toppings_v"), _top_listed("extras", "extras_id"))
job("top_exclusion", ("clean_orders_v", "toppings_v"), _top_listed("exclusions", "exclusions_id"))


def _names_in_order(col: str, out: str) -> str:
    return f"""
SELECT u.rid, string_agg(t.topping_name, ', ' ORDER BY u.pos) AS {out}
FROM (SELECT rid, unnest(string_split({col}, ', ')) AS tid,
             unnest(generate_series(1, len(string_split({col}, ', ')))) AS pos
      FROM co WHERE {col} IS NOT NULL) u
JOIN toppings_v t ON CAST(u.tid AS INTEGER) = t.topping_id GROUP BY u.rid"""


job("order_item_label", ("clean_orders_v", "toppings_v", "pizza_names_v"), f"""
WITH co AS (SELECT *, row_number() OVER () AS rid FROM clean_orders_v),
ex AS ({_names_in_order("exclusions", "excl")}),
xt AS ({_names_in_order("extras", "extra")})
SELECT co.order_id, co.pizza_id,
       concat_ws('', n.pizza_name,
                 CASE WHEN ex.excl IS NOT NULL THEN ' - Exclude ' || ex.excl END,
                 CASE WHEN xt.extra IS NOT NULL THEN ' - Extra ' || xt.extra END) AS order_item
FROM co LEFT JOIN pizza_names_v n ON co.pizza_id = n.pizza_id
LEFT JOIN ex ON co.rid = ex.rid LEFT JOIN xt ON co.rid = xt.rid""")

job("ingredient_list", ("clean_orders_v", "recipe_v", "toppings_v", "pizza_names_v"), """
WITH co AS (SELECT *, row_number() OVER () AS rid FROM clean_orders_v),
base AS (SELECT co.rid, CAST(unnest(string_split(r.toppings, ', ')) AS INTEGER) AS tid, co.exclusions
         FROM co JOIN recipe_v r ON co.pizza_id = r.pizza_id),
kept AS (SELECT rid, tid FROM base
         WHERE NOT coalesce(list_contains(CAST(string_split(exclusions, ', ') AS INTEGER[]), tid), false)),
added AS (SELECT rid, CAST(unnest(string_split(extras, ', ')) AS INTEGER) AS tid FROM co WHERE extras IS NOT NULL),
cnt AS (SELECT rid, tid, COUNT(*) AS n FROM (SELECT * FROM kept UNION ALL SELECT * FROM added) GROUP BY rid, tid),
lst AS (SELECT rid, string_agg(CASE WHEN n > 1 THEN CAST(n AS VARCHAR) || 'x' || t.topping_name ELSE t.topping_name END,
                               ', ' ORDER BY t.topping_name) AS lst
        FROM cnt JOIN toppings_v t ON cnt.tid = t.topping_id GROUP BY rid)
SELECT co.order_id, co.pizza_id, n.pizza_name || ': ' || coalesce(lst.lst, '') AS ingredients
FROM co LEFT JOIN pizza_names_v n ON co.pizza_id = n.pizza_id LEFT JOIN lst ON co.rid = lst.rid""")

# One tagged list of (id, kind, count); equal (id, count) of different kinds collapse, as in the job (UNION DISTINCT).
job("ingredient_totals", ("clean_orders_v", "recipe_v"), """
WITH tagged AS (
  SELECT 'r' AS kind, unnest(string_split(r.toppings, ', '))::INTEGER AS id, o.pizza_id AS product
  FROM clean_orders_v o JOIN recipe_v r USING (pizza_id)
  UNION ALL BY NAME SELECT 'x' AS kind, unnest(string_split(exclusions, ', '))::INTEGER AS id FROM clean_orders_v
  UNION ALL BY NAME SELECT 'e' AS kind, unnest(string_split(extras, ', '))::INTEGER AS id FROM clean_orders_v),
counts AS (SELECT DISTINCT id, IF(kind = 'x', -n, n) AS n
           FROM (SELECT kind, id, product, COUNT(*) AS n FROM tagged GROUP BY ALL))
SELECT id AS toppings, SUM(n)::BIGINT AS num FROM counts GROUP BY id ORDER BY num DESC""")

job("add_product", ("recipe_v", "toppings_v", "pizza_names_v"), """
WITH nm AS (SELECT pizza_id, pizza_name FROM pizza_names_v
            UNION ALL SELECT MAX(pizza_id) + 1, 'Supreme' FROM pizza_names_v),
rc AS (SELECT pizza_id, toppings FROM recipe_v
       UNION ALL SELECT (SELECT MAX(pizza_id) + 1 FROM pizza_names_v), '1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12')
""" + STANDARD.format(recipes="rc", names="nm"))

JOBS["add_product_stored"] = JOBS["add_product"]

# --- money and ratings --------------------------------------------------------

job("revenue", ("clean_orders_v", "menu_v"), f"""
SELECT CAST(SUM({PREMIUM}) AS BIGINT) AS total_revenue FROM {PRICED}""")

job("revenue_with_extras", ("clean_orders_v", "menu_v"), f"""
SELECT CAST(SUM({PREMIUM}) + SUM(len(string_split(c.extras, ', '))) AS BIGINT) AS total_revenue FROM {PRICED}""")

RATING = "CAST(((('0x' || substr(md5('rating:' || d.order_id || ':' || d.runner_id), 1, 13))::BIGINT * 5) >> 52) + 1 AS INTEGER)"

job("ratings", ("clean_deliveries_v",), f"""
SELECT d.order_id, d.runner_id, {RATING} AS rating FROM clean_deliveries_v d""")

job("delivery_summary", ("clean_orders_v", "clean_deliveries_v"), f"""
WITH p AS (SELECT order_id, customer_id, order_time, COUNT(pizza_id) AS num_items
           FROM clean_orders_v GROUP BY order_id, customer_id, order_time)
SELECT p.customer_id, d.order_id, d.runner_id, {RATING} AS rating, p.order_time, d.pickup_time,
       date_diff('second', p.order_time, d.pickup_time) AS wait_seconds, d.duration,
       {exact_round("60 * CAST(d.distance * 100 AS BIGINT)", "CAST(d.duration * 100 AS BIGINT)")} AS average_speed,
       p.num_items
FROM clean_deliveries_v d JOIN p ON d.order_id = p.order_id""")

# The set {sales, -delivery costs}: equal amounts would collapse (UNION DISTINCT), as in the job.
job("net_revenue", ("clean_orders_v", "clean_deliveries_v", "menu_v"), f"""
WITH amounts(v) AS (
  SELECT unnest(list_distinct([
    (SELECT SUM({PREMIUM})::DECIMAL(38,3) FROM {PRICED})]))
  UNION SELECT DISTINCT (distance * -0.30)::DECIMAL(38,3) FROM (SELECT SUM(distance) AS distance FROM clean_deliveries_v)
) SELECT SUM(v)::DECIMAL(38,3) AS total_revenue FROM amounts""")

# --- subscriptions ------------------------------------------------------------

job("total_customers", ("subs_v",), "SELECT COUNT(DISTINCT customer_id) AS total_customers FROM subs_v")

# A trial starts with a customer's first order: the events table lies in one month.
job("monthly_trials", (), """
SELECT CAST(month(d) AS INTEGER) AS months, COUNT(*) AS trials
FROM (SELECT MIN(CAST(o_orderdate AS DATE)) AS d FROM orders GROUP BY o_custkey) GROUP BY 1 ORDER BY 1""")

job("starts_after", ("subs_v",), """
SELECT plan_id, COUNT(*) AS starts FROM subs_v WHERE start_date > DATE '2024-01-15'
GROUP BY plan_id ORDER BY plan_id""")

job("churn_percent", ("subs_v", "total_v"), f"""
SELECT c.num AS churned_customers, {_pct("c.num", "t.num")} AS churned_percent
FROM (SELECT COUNT(DISTINCT customer_id) AS num FROM subs_v WHERE plan_id = 4) c, total_v t""")

job("direct_churn", ("next_v", "total_v"), f"""
SELECT c.num AS left_after_trial, {_pct("c.num", "t.num")} AS left_percent
FROM (SELECT COUNT(DISTINCT customer_id) AS num FROM next_v WHERE plan_id = 0 AND next_plan = 4) c, total_v t""")

job("conversion_share", ("next_v",), f"""
SELECT plan_id, COUNT(*) FILTER (chosen) AS chosen_after_trial, COUNT(DISTINCT who) AS customers,
       {_round_pct("COUNT(*) FILTER (chosen)", "COUNT(DISTINCT who)")} AS chosen_percent
FROM (SELECT plan_id, customer_id AS who, false AS chosen FROM next_v
      UNION ALL SELECT next_plan, NULL, true FROM next_v WHERE plan_id = 0 AND next_plan IS NOT NULL)
GROUP BY plan_id HAVING bool_or(chosen) AND NOT bool_and(chosen)""")

job("plan_snapshot", ("next_v", "total_v"), f"""
SELECT plan_id, customers, {_round_pct("customers", "(SELECT num FROM total_v)")} AS percent FROM (
  SELECT plan_id, COUNT(DISTINCT customer_id) AS customers FROM next_v
  WHERE start_date < DATE '2024-01-15' AND COALESCE(next_date, 'infinity'::TIMESTAMP) > DATE '2024-01-15' GROUP BY plan_id)""")

job("annual_upgrades", ("next_v",), """
SELECT COUNT(DISTINCT customer_id) AS annual_upgrades FROM next_v WHERE next_plan = 3 AND year(start_date) = 2024""")

job("days_to_upgrade", ("days_v",), f"""
SELECT {exact_round("SUM(days)", "COUNT(days)")} AS mean_days FROM days_v""")

job("upgrade_histogram", ("days_v",), """
SELECT CAST((b - 1) * 10 AS VARCHAR) || '-' || CAST(b * 10 AS VARCHAR) AS day_range, COUNT(*) AS customers
FROM (SELECT CASE WHEN days < 0 THEN 0 WHEN days >= 30 THEN 4 ELSE days // 10 + 1 END AS b FROM days_v)
GROUP BY b ORDER BY b""")

# The plain self-join, all pairs made.
UPGRADES = """
FROM subs_v a JOIN subs_v b ON a.customer_id = b.customer_id AND a.plan_id = 0 AND b.plan_id = 3"""
PAIR_DAYS = "(CAST(b.start_date AS DATE) - CAST(a.start_date AS DATE))"

job("days_to_upgrade_pairs", ("subs_v",), f"""
SELECT {exact_round(f"SUM{PAIR_DAYS}", f"COUNT{PAIR_DAYS}")} AS mean_days {UPGRADES}""")

job("upgrade_histogram_pairs", ("subs_v",), f"""
SELECT CAST((b - 1) * 10 AS VARCHAR) || '-' || CAST(b * 10 AS VARCHAR) AS day_range, COUNT(*) AS upgrades
FROM (SELECT CASE WHEN days < 0 THEN 0 WHEN days >= 30 THEN 4 ELSE days // 10 + 1 END AS b FROM (SELECT {PAIR_DAYS} AS days {UPGRADES}))
GROUP BY b ORDER BY b""")

job("downgrades", ("next_v",), """
SELECT COUNT(*) AS customers_downgraded FROM next_v WHERE plan_id = 2 AND next_plan = 1""")

# --- payment schedule ---------------------------------------------------------

# Payments by date, numbered by counting: each payment's neighbours are those with the next higher and lower number.
# Departs from the survey on ties: equal payment dates are ordered by interval (start_date, order_key), not by plan.
job("payments", ("timeline_v", "plans_v"), """
WITH changes AS (
  SELECT customer_id, plan_id, start_date, order_key,
         row_number() OVER (PARTITION BY customer_id ORDER BY start_date, order_key) AS i
  FROM timeline_v WHERE plan_id <> 0),
paid AS (
  SELECT a.customer_id, a.plan_id, a.i, unnest(generate_series(
           a.start_date::TIMESTAMP, COALESCE(b.start_date, DATE '1998-12-31')::TIMESTAMP,
           to_months(IF(a.plan_id = 3, 12, 1))))::DATE AS d
  FROM changes a LEFT JOIN changes b ON b.customer_id = a.customer_id AND b.i = a.i + 1 WHERE a.plan_id <> 4),
listed AS (
  SELECT customer_id, list(struct_pack(plan := plan_id, d := d) ORDER BY i, d) AS l FROM paid GROUP BY customer_id),
held AS (
  SELECT customer_id, list_filter(l, lambda x, k: NOT (x.plan = 2 AND coalesce(l[k + 1].plan = 3, false))) AS l FROM listed),
flat AS (
  SELECT customer_id, unnest(l) AS x, unnest(range(1, len(l) + 1)) AS k,
         unnest(list_transform(l, lambda x, k: x.plan IN (2, 3) AND k > 1 AND coalesce(l[k - 1].plan = 1, false))) AS credit
  FROM held)
SELECT customer_id, x.plan AS plan_id, plan_name, x.d AS payment_date,
       (price - IF(credit, 9.90, 0))::DECIMAL(6,2) AS price, k::INTEGER AS payment_order
FROM flat JOIN plans_v ON plans_v.plan_id = x.plan WHERE x.d <= DATE '1998-12-31'""")

job("list_pairs", ("clean_orders_v",), """
WITH lists AS (SELECT order_id, pizza_id, coalesce(string_split(exclusions, ', ')::INTEGER[], []) AS a,
                      coalesce(string_split(extras, ', ')::INTEGER[], []) AS b FROM clean_orders_v)
SELECT order_id, pizza_id, a[k] AS exclusion_id, b[k] AS extra_id
FROM (SELECT *, unnest(range(1, greatest(len(a), len(b), 1) + 1)) AS k FROM lists)""")

JOBS["first_item_spread"] = JOBS["first_item"]

job("customers_sketched", ("subs_v",), """
SELECT plan_id, COUNT(DISTINCT customer_id) AS customers, TRUE AS within_bound FROM subs_v GROUP BY plan_id""")

# The same jobs on tables laid out by the order key.
for _name in ("spend_per_customer", "delivered_per_type", "delivery_summary"):
    JOBS[f"{_name}_colocated"] = JOBS[_name]
