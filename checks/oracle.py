"""The registered queries as DuckDB SQL over the sample tables.

Amounts are whole cents and ratios are divided half up in whole numbers; only
the last step turns them into doubles.
"""

from __future__ import annotations

from ordermill.plans.audits import (
    ITEMS_PER_ORDER, OPTIONS_PER_LINE, ORDERS_PER_CUSTOMER, PERCENTILES, QUANTITY_RANGES,
)
from ordermill.sources.holidays import holiday_rows


def div(num: str, den: str) -> str:
    """Whole-number quotient rounded half away from zero, NULL for a zero denominator."""
    n, d = f"CAST({num} AS HUGEINT)", f"NULLIF(CAST({den} AS HUGEINT), 0)"
    return f"(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})))"


def usd(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


def avg2(cents: str, count: str) -> str:
    """Mean amount to the cent."""
    return usd(div(cents, count))


def ratio2(num: str, den: str) -> str:
    return usd(div(f"({num}) * 100", den))


def pct1(part: str, whole: str) -> str:
    return f"CAST({div(f'({part}) * 1000', whole)} AS DOUBLE) / 10"


def pct2(part: str, whole: str) -> str:
    return usd(div(f"({part}) * 10000", whole))


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


RAW_ORDER = "app, rest, ts, user_id NULLS FIRST, card NULLS FIRST, loyal, category NULLS FIRST, item, price_c, qty"


def clean_items(name: str, source: str) -> str:
    return f"""
{name}_kept AS (
  SELECT * REPLACE (CASE WHEN coalesce(trim(category), '') = '' THEN 'Unknown' ELSE trim(category) END AS category)
  FROM {source}
  WHERE app <> 'Shop - DEVELOPMENT' AND rest <> 'R27' AND (category IS NULL OR category <> 'Test Items')
    AND price_c BETWEEN 0 AND 5000 AND qty BETWEEN 1 AND 20),
{name} AS (
  SELECT * EXCLUDE (rn), CAST(ts AS DATE) AS order_date, hour(ts) AS order_hour, price_c * qty AS rev_c
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id, line_id ORDER BY {RAW_ORDER}) AS rn FROM {name}_kept)
  WHERE rn = 1)"""


def clean_opts(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT order_id, line_id,
    array_to_string(list_transform(string_split(lower(regexp_replace(trim(grp), '^[Cc][Tt]\\s+', '')), ' '),
      lambda w: upper(w[1]) || w[2:]), ' ') AS grp,
    trim(opt) AS opt, min(price_c) AS price_c, 1 AS qty
  FROM {source} WHERE price_c >= 0 GROUP BY ALL)"""


def order_fact(name: str, items: str, opts: str) -> str:
    return f"""
{name}_lines AS (
  SELECT order_id, line_id, sum(price_c * qty) AS opt_c, count(*) FILTER (price_c > 0) AS paid
  FROM {opts} GROUP BY 1, 2),
{name} AS (
  SELECT i.order_id, min(user_id) AS user_id, min(rest) AS rest, min(order_date) AS order_date, min(ts) AS ts,
    min(order_hour) AS order_hour, count(*) AS item_count, CAST(sum(rev_c) AS BIGINT) AS item_c,
    CAST(coalesce(sum(opt_c), 0) AS BIGINT) AS opt_c, CAST(coalesce(sum(paid), 0) AS BIGINT) AS paid,
    bool_or(loyal) AS loyal, min(app) AS app,
    CAST(sum(rev_c) + coalesce(sum(opt_c), 0) AS BIGINT) AS total_c
  FROM {items} i LEFT JOIN {name}_lines l ON i.order_id = l.order_id AND i.line_id = l.line_id GROUP BY 1)"""


RAW = """
items_raw AS (
  SELECT CASE WHEN l_partkey % 97 = 0 THEN 'Shop - DEVELOPMENT' WHEN l_partkey % 50 = 1 THEN 'Shop Perks'
      ELSE 'Shop' END AS app,
    'R' || CAST(o_orderkey % 28 AS VARCHAR) AS rest,
    CAST(o_orderdate AS TIMESTAMP) + to_days(9131) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS ts,
    CASE WHEN o_orderkey % 100 = 0 THEN 'Z' ELSE '.000Z' END AS ts_end,
    CAST(l_orderkey AS VARCHAR) AS order_id,
    CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS user_id,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'C' || CAST(o_custkey AS VARCHAR) END AS card,
    o_orderpriority = '1-URGENT' AS loyal,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_id,
    CASE WHEN l_suppkey % 40 = 0 THEN p_type || 'https://x.example/' WHEN l_suppkey % 40 = 1 THEN ''
      WHEN l_suppkey % 40 = 2 THEN ' ' || p_type || ' ' WHEN l_partkey % 499 = 0 THEN 'Test Items'
      ELSE p_type END AS category,
    p_name AS item, CAST(round(l_extendedprice * 100) AS BIGINT) % 5200 AS price_c,
    CAST(l_quantity AS INTEGER) % 23 AS qty
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
opts_raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_id,
    CASE l_returnflag WHEN 'A' THEN 'CT Milk Options' WHEN 'N' THEN 'MILK OPTIONS' ELSE 'Syrup' END AS grp,
    ' add ' || l_linestatus || CAST(l_suppkey % 5 AS VARCHAR) || ' ' AS opt,
    CAST(round(l_tax * 100) AS BIGINT) * 100 AS price_c
  FROM lineitem WHERE l_discount > 0),
cal_raw AS (
  SELECT DISTINCT CAST(CAST(o_orderdate AS TIMESTAMP) + to_days(9131) AS DATE) AS d FROM orders),
cal_numbered AS (SELECT d, date_diff('day', DATE '1970-01-01', d) AS number FROM cal_raw)"""

_holidays = ", ".join("(DATE '{}', '{}')".format(d, n.replace("'", "''")) for d, n in holiday_rows())

METRICS = f"""
holidays(d, holiday_name) AS (VALUES {_holidays}),
days AS (
  SELECT CAST(unnest(generate_series(CAST(min(order_date) AS TIMESTAMP), CAST(max(order_date) AS TIMESTAMP),
    INTERVAL 1 DAY)) AS DATE) AS date_key FROM items),
cust_base AS (
  SELECT user_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
    count(DISTINCT order_id) AS total_orders, CAST(sum(rev_c) AS BIGINT) AS spend_c, bool_or(loyal) AS is_loyalty
  FROM items WHERE user_id IS NOT NULL GROUP BY 1),
cust_place AS (
  SELECT user_id, rest FROM (
    SELECT user_id, rest, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, rest) AS rn
    FROM items WHERE user_id IS NOT NULL GROUP BY 1, 2) WHERE rn = 1),
cust AS (
  SELECT b.*, p.rest AS place,
    CASE ntile(5) OVER (ORDER BY spend_c, b.user_id) WHEN 5 THEN 'High' WHEN 1 THEN 'Low' ELSE 'Medium' END AS clv_tier
  FROM cust_base b LEFT JOIN cust_place p USING (user_id)),
known AS (SELECT * FROM fact WHERE user_id IS NOT NULL),
today AS (SELECT max(order_date) AS d FROM known),
spend_days AS (
  SELECT user_id, order_date, sum(total_c) AS rev_c, count(*) AS n FROM known GROUP BY 1, 2),
grid AS (
  SELECT c.user_id, d.date_key, c.first_order_date, coalesce(s.rev_c, 0) AS rev_c, coalesce(s.n, 0) AS n
  FROM cust c JOIN days d ON d.date_key >= c.first_order_date
  LEFT JOIN spend_days s ON s.user_id = c.user_id AND s.order_date = d.date_key),
clv_sums AS (
  SELECT user_id, date_key, CAST(rev_c AS BIGINT) AS rev_c, CAST(n AS BIGINT) AS n, first_order_date,
    CAST(sum(rev_c) OVER w AS BIGINT) AS spend_c, CAST(sum(n) OVER w AS BIGINT) AS orders,
    max(CASE WHEN n > 0 THEN date_key END) OVER w AS last_day
  FROM grid WINDOW w AS (PARTITION BY user_id ORDER BY date_key ROWS UNBOUNDED PRECEDING)),
clv AS (
  SELECT *, CASE WHEN spend_c <= 0 THEN 'Pre-Activity'
    ELSE CASE ntile(5) OVER (PARTITION BY date_key ORDER BY spend_c, user_id)
      WHEN 5 THEN 'High' WHEN 1 THEN 'Low' ELSE 'Medium' END END AS clv_tier
  FROM clv_sums),
rfm_measures AS (
  SELECT c.user_id, c.is_loyalty, max(k.order_date) AS last_day,
    date_diff('day', max(k.order_date), (SELECT d FROM today)) AS recency,
    count(k.order_id) FILTER (k.order_date >= (SELECT d FROM today) - 365) AS frequency,
    CAST(coalesce(sum(k.total_c) FILTER (k.order_date >= (SELECT d FROM today) - 365), 0) AS BIGINT) AS monetary_c,
    count(k.order_id) AS frequency_all, CAST(coalesce(sum(k.total_c), 0) AS BIGINT) AS monetary_all_c
  FROM cust c LEFT JOIN known k USING (user_id) GROUP BY 1, 2),
rfm_scores AS (
  SELECT *, ntile(5) OVER (ORDER BY recency DESC NULLS LAST, user_id) AS r,
    ntile(5) OVER (ORDER BY frequency, user_id) AS f, ntile(5) OVER (ORDER BY monetary_c, user_id) AS m,
    ntile(5) OVER (ORDER BY frequency_all, user_id) AS f_all,
    ntile(5) OVER (ORDER BY monetary_all_c, user_id) AS m_all
  FROM rfm_measures),
rfm AS (
  SELECT *, CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'VIP' WHEN f >= 4 AND m >= 3 THEN 'Loyal'
      WHEN m >= 4 THEN 'Big Spender' WHEN r >= 4 AND f <= 2 THEN 'New Customer'
      WHEN r <= 2 AND f >= 3 THEN 'At Risk' WHEN r <= 2 AND f <= 2 AND m <= 2 THEN 'Churn Risk'
      ELSE 'Regular' END AS segment,
    CASE WHEN is_loyalty THEN 'Loyalty' WHEN NOT is_loyalty THEN 'Non-Loyalty' ELSE 'Unknown' END AS loyalty_label
  FROM rfm_scores),
churn_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY order_date, ts, order_id) AS rn,
    count(*) OVER (PARTITION BY user_id) AS n FROM known),
churn_sums AS (
  SELECT user_id, max(n) AS n, min(order_date) AS first_day, max(order_date) AS last_day,
    CAST(sum(total_c) FILTER (rn = n) AS BIGINT) AS recent_c, CAST(sum(total_c) FILTER (rn < n) AS BIGINT) AS prior_sum_c
  FROM churn_ranked GROUP BY 1 HAVING count(*) >= 2),
churn_base AS (
  SELECT *, CAST({div('prior_sum_c', 'n - 1')} AS BIGINT) AS prior_c,
    CAST({div("date_diff('day', first_day, last_day) * 10", 'n - 1')} AS BIGINT) AS gap_tenths,
    date_diff('day', last_day, (SELECT d FROM today)) AS days
  FROM churn_sums),
churn_gap AS (SELECT *, CASE WHEN gap_tenths <= 0 THEN 10 ELSE gap_tenths END AS gap FROM churn_base),
churn AS (
  SELECT user_id, n AS total_orders, first_day AS first_order_date, last_day AS last_order_date,
    {usd('recent_c')} AS recent_spend, {usd('prior_c')} AS prior_avg_spend,
    CAST(gap_tenths AS DOUBLE) / 10 AS avg_gap_days, days AS days_since_last_order,
    CASE WHEN days <= 30 THEN 'Active' WHEN days <= 45 THEN 'Cooling Off' WHEN days <= 60 THEN 'At Risk'
      ELSE 'Inactive' END AS churn_tag,
    CASE WHEN days * 100 <= gap * 15 THEN 'Active' WHEN days * 100 <= gap * 20 THEN 'Cooling Off'
      WHEN days * 100 <= gap * 30 THEN 'At Risk' ELSE 'Inactive' END AS churn_tag_personal,
    CASE WHEN prior_c > 0 THEN {pct1('recent_c - prior_c', 'prior_c')} END AS spend_change_pct
  FROM churn_gap),
daily AS (
  SELECT order_date, rest AS restaurant_id, category AS item_category, count(DISTINCT order_id) AS order_count,
    count(DISTINCT user_id) AS unique_customers, CAST(sum(rev_c) AS BIGINT) AS rev_c,
    count(*) FILTER (loyal) AS loyalty_line_items
  FROM items GROUP BY 1, 2, 3),
weekly AS (
  SELECT year(order_date) AS order_year, week(order_date) AS order_week, rest AS restaurant_id,
    count(*) AS order_count, count(DISTINCT user_id) AS unique_customers, CAST(sum(total_c) AS BIGINT) AS total_c,
    count(*) FILTER (loyal) AS loyalty_orders
  FROM fact GROUP BY 1, 2, 3),
monthly AS (
  SELECT year(order_date) AS order_year, month(order_date) AS order_month,
    strftime(order_date, '%Y-%m') AS order_year_month, rest AS restaurant_id,
    count(*) AS order_count, count(DISTINCT user_id) AS unique_customers, CAST(sum(total_c) AS BIGINT) AS total_c,
    count(*) FILTER (loyal) AS loyalty_orders, CAST(sum(opt_c) AS BIGINT) AS opt_c
  FROM fact GROUP BY 1, 2, 3, 4),
labelled AS (
  SELECT *, CASE WHEN user_id IS NULL THEN 'Anonymous' WHEN loyal THEN 'Loyalty' ELSE 'Non-Loyalty' END AS segment
  FROM fact),
loyalty_users AS (
  SELECT segment, user_id, count(*) AS n, sum(total_c) AS c FROM labelled WHERE user_id IS NOT NULL GROUP BY 1, 2),
loyalty_stats AS (
  SELECT segment, {ratio2('sum(n)', 'count(*)')} AS avg_orders_per_customer,
    {avg2('sum(c)', 'count(*)')} AS avg_customer_spend,
    {pct1('count(*) FILTER (n >= 2)', 'count(*)')} AS repeat_customer_rate_pct
  FROM loyalty_users GROUP BY 1),
loyalty AS (
  SELECT l.segment, count(DISTINCT user_id) AS customer_count, count(*) AS order_count,
    CAST(sum(total_c) AS BIGINT) AS total_c, {avg2('sum(total_c)', 'count(*)')} AS avg_spend_per_order,
    any_value(avg_orders_per_customer) AS avg_orders_per_customer, any_value(avg_customer_spend) AS avg_customer_spend,
    any_value(repeat_customer_rate_pct) AS repeat_customer_rate_pct,
    {pct1('count(*) FILTER (paid > 0)', 'count(*)')} AS option_attach_rate_pct
  FROM labelled l LEFT JOIN loyalty_stats s ON l.segment = s.segment GROUP BY 1),
visits AS (
  SELECT rest, user_id, count(DISTINCT order_id) AS n FROM known GROUP BY 1, 2),
retention AS (
  SELECT rest, count(*) FILTER (n >= 2) AS repeats, {pct1('count(*) FILTER (n >= 2)', 'count(*)')} AS retention_rate_pct
  FROM visits GROUP BY 1),
places AS (
  SELECT f.rest AS restaurant_id, count(*) AS total_orders, count(DISTINCT user_id) AS unique_customers,
    CAST(sum(total_c) AS BIGINT) AS total_c, count(DISTINCT (year(order_date), week(order_date))) AS active_weeks,
    min(order_date) AS first_order_date, max(order_date) AS last_order_date, count(*) FILTER (loyal) AS loyals,
    any_value(repeats) AS repeats, any_value(retention_rate_pct) AS retention_rate_pct
  FROM fact f LEFT JOIN retention r ON f.rest = r.rest GROUP BY 1),
locations AS (
  SELECT *, row_number() OVER (ORDER BY total_c DESC, restaurant_id) AS revenue_rank,
    row_number() OVER (ORDER BY total_orders DESC, restaurant_id) AS orders_rank,
    row_number() OVER (ORDER BY unique_customers DESC, restaurant_id) AS customers_rank
  FROM places),
upsell_counts AS (
  SELECT (SELECT count(*) FROM opts) AS n, (SELECT count(*) FROM opts WHERE price_c > 0) AS p,
    (SELECT CAST(sum(price_c * qty) AS BIGINT) FROM opts) AS opt_c, (SELECT count(*) FROM fact) AS orders,
    (SELECT count(*) FROM fact WHERE paid > 0) AS upsold, (SELECT CAST(sum(total_c) AS BIGINT) FROM fact) AS total_c),
upsell AS (
  SELECT n AS total_option_rows, n - p AS free_option_rows, p AS paid_option_rows,
    {pct2('n - p', 'n')} AS free_option_pct, {pct2('p', 'n')} AS paid_option_pct,
    {usd('opt_c')} AS total_option_revenue, orders AS total_orders, upsold AS orders_with_paid_options,
    {pct2('upsold', 'orders')} AS order_upsell_rate_pct, {usd('total_c')} AS total_order_revenue,
    coalesce({pct2('opt_c', 'total_c')}, 0) AS upsell_share_of_revenue_pct,
    coalesce({avg2('opt_c', 'upsold')}, 0) AS avg_option_revenue_per_upsell_order
  FROM upsell_counts),
top_options AS (
  SELECT grp AS option_group_name, opt AS option_name, count(*) AS attach_count,
    CAST(sum(price_c * qty) AS BIGINT) AS c, {avg2('sum(price_c)', 'count(*)')} AS avg_price
  FROM opts WHERE price_c > 0 GROUP BY 1, 2)"""

BASE = RAW + "," + clean_items("items", "items_raw") + "," + clean_opts("opts", "opts_raw") + "," \
    + order_fact("fact", "items", "opts") + "," + METRICS

PURCHASES = RAW + """,
purchases AS (
  SELECT 'Shop' AS app, 'R' || CAST(user_id % 5 AS VARCHAR) AS rest, CAST(ts AS TIMESTAMP) AS ts, 'Z' AS ts_end,
    'e' || CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS card,
    user_id % 4 = 0 AS loyal, 'e' || CAST(event_id AS VARCHAR) AS line_id, event_type AS category, event_type AS item,
    CAST(round(value * 100) AS BIGINT) % 5200 AS price_c, 1 AS qty
  FROM events WHERE event_type = 'purchase')""" + "," + clean_items("items", "purchases") + "," \
    + clean_opts("opts", "opts_raw") + "," + order_fact("fact", "items", "opts") + "," + METRICS

# The daily run reduces repeated keys in the raw layer already.
RAW_KEYED = RAW + f""",
items_keyed AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, line_id ORDER BY {RAW_ORDER}) AS rn FROM items_raw) WHERE rn = 1),
opts_keyed AS (SELECT order_id, line_id, grp, opt, min(price_c) AS price_c FROM opts_raw GROUP BY 1, 2, 3, 4)"""

BASE_KEYED = RAW_KEYED + "," + clean_items("items", "items_keyed") + "," + clean_opts("opts", "opts_keyed") + "," \
    + order_fact("fact", "items", "opts") + "," + METRICS


def q(select: str, base: str = BASE) -> str:
    return f"WITH {base}\n{select}"


def ranges(value: str, bounds) -> str:
    lines = [
        f"WHEN {value} >= {low} THEN '{label}'" if high is None else f"WHEN {value} BETWEEN {low} AND {high} THEN '{label}'"
        for low, high, label in bounds
    ]
    return "CASE " + " ".join(lines) + " END"


def stage_lines(counts: str, names: list[str]) -> str:
    """One line per stage from a one-row table with a column per stage."""
    lines = []
    for i, name in enumerate(names):
        before = names[max(i - 1, 0)]
        lines.append(
            f"SELECT CAST({i} AS BIGINT) AS step, '{name}' AS stage, {big(name)} AS rows_left, "
            f"{big(f'{before} - {name}')} AS rows_removed, {pct2(name, 'input')} AS retained_pct FROM {counts}")
    return " UNION ALL ".join(lines)


ITEM_STAGES = ["input", "after_test_data", "after_null_keys", "after_outliers", "after_dedupe"]
OPTION_STAGES = ["input", "after_null_keys", "after_values", "after_dedupe"]
_real = "app <> 'Shop - DEVELOPMENT' AND rest <> 'R27' AND category <> 'Test Items'"
STAGES = BASE + f""",
item_counts AS (
  SELECT count(*) AS input, count(*) FILTER ({_real}) AS after_test_data, count(*) FILTER ({_real}) AS after_null_keys,
    (SELECT count(*) FROM items_kept) AS after_outliers, (SELECT count(*) FROM items) AS after_dedupe FROM items_raw),
option_counts AS (
  SELECT count(*) AS input, count(*) AS after_null_keys, count(*) AS after_values,
    (SELECT count(*) FROM opts) AS after_dedupe FROM opts_raw)"""

DAMAGED = RAW + f""",
damaged AS (
  SELECT * EXCLUDE (n) REPLACE (
    CASE n % 23 WHEN 0 THEN 'Grill BBQ Plates 2' WHEN 1 THEN 'Bowls0' WHEN 2 THEN '  Sandwiches, hot' WHEN 3 THEN 'Drip C0offee'
      WHEN 4 THEN 'Sqalads' WHEN 5 THEN 'Kids' WHEN 6 THEN 'Kid''s Menu' WHEN 7 THEN NULL WHEN 8 THEN '   ' ELSE category END AS category,
    CASE WHEN n % 29 <> 0 THEN app END AS app, CASE WHEN n % 31 <> 0 THEN rest END AS rest,
    CASE WHEN n % 43 <> 0 AND n % 47 <> 0 AND n % 53 <> 0 THEN ts END AS ts,
    CASE n % 13 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE loyal END AS loyal,
    CASE WHEN n % 17 = 0 AND card IS NOT NULL THEN 'S' || CAST(n % 5 AS VARCHAR) ELSE card END AS card,
    CASE WHEN n % 37 <> 0 THEN order_id END AS order_id, CASE WHEN n % 41 <> 0 THEN line_id END AS line_id)
  FROM (SELECT *, CAST(split_part(line_id, '-', 1) AS BIGINT) * 7 + CAST(split_part(line_id, '-', 2) AS BIGINT) AS n FROM items_raw)),
told AS (
  SELECT *, coalesce(app <> 'Shop - DEVELOPMENT' AND rest <> 'R27' AND (category IS NULL OR category <> 'Test Items'), false) AS real,
    order_id IS NOT NULL AND line_id IS NOT NULL AS keyed, price_c BETWEEN 0 AND 5000 AND qty BETWEEN 1 AND 20 AS in_range FROM damaged),
kept AS (
  SELECT * REPLACE (CASE WHEN coalesce(trim(category), '') = '' THEN 'Unknown' WHEN contains(category, 'BBQ Plates') THEN 'BBQ Plates'
      WHEN category = 'Bowls0' THEN 'Bowls' WHEN regexp_matches(category, '^\\s*Sandwiches') THEN 'Sandwiches'
      WHEN contains(category, 'Drip C') AND contains(category, 'offee') THEN 'Drip Coffee' WHEN category = 'Sqalads' THEN 'Salads'
      WHEN category = 'Kids' OR starts_with(category, 'Kid''s') THEN 'Kid''s' ELSE trim(category) END AS category)
  FROM told WHERE real AND keyed AND in_range),
items AS (
  SELECT * EXCLUDE (rn), CAST(ts AS DATE) AS order_date, hour(ts) AS order_hour, price_c * qty AS rev_c
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id, line_id ORDER BY app, rest, ts NULLS FIRST, user_id NULLS FIRST,
    card NULLS FIRST, loyal NULLS FIRST, category, item, price_c, qty) AS rn FROM kept) WHERE rn = 1),
item_counts AS (
  SELECT count(*) AS input, count(*) FILTER (real) AS after_test_data, count(*) FILTER (real AND keyed) AS after_null_keys,
    count(*) FILTER (real AND keyed AND in_range) AS after_outliers, (SELECT count(*) FROM items) AS after_dedupe FROM told)"""

DIGEST = "SELECT app AS \"APP_NAME\", rest AS \"RESTAURANT_ID\", count(*) AS row_count, " \
    f"count(DISTINCT order_id) AS orders, {usd('sum(price_c)')} AS price_sum FROM {{}} GROUP BY 1, 2"

UPSERTED = RAW_KEYED + f""",
source_rows AS (
  SELECT * REPLACE (CASE WHEN app = 'Shop Perks' THEN price_c + 100 ELSE price_c END AS price_c,
    CASE WHEN rest = 'R0' THEN 'n' || line_id ELSE line_id END AS line_id)
  FROM items_raw WHERE app = 'Shop Perks' OR rest = 'R0'),
source_keyed AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, line_id ORDER BY {RAW_ORDER}) AS rn FROM source_rows) WHERE rn = 1),
merged AS (
  SELECT * FROM items_keyed t WHERE NOT EXISTS (
    SELECT 1 FROM source_keyed s WHERE s.order_id = t.order_id AND s.line_id = t.line_id)
  UNION ALL SELECT * FROM source_keyed)"""

RELOADED = RAW + "," + clean_items("items_before", "items_raw") + "," + clean_opts("opts", "opts_raw") + """,
items_again AS (
  SELECT * REPLACE (price_c + 100 AS price_c) FROM items_raw
  WHERE CAST(ts AS DATE) BETWEEN DATE '2022-03-10' AND DATE '2022-05-20')""" + "," + clean_items("items_new", "items_again") + """,
items AS (
  SELECT * FROM items_before b WHERE NOT EXISTS (
    SELECT 1 FROM items_new n WHERE n.order_id = b.order_id AND n.line_id = b.line_id)
  UNION ALL SELECT * FROM items_new)""" + "," + order_fact("fact", "items", "opts")


MOVED = RAW + f""",
items_moved AS (
  SELECT * REPLACE (CASE WHEN strftime(ts, '%Y-%m') = '2022-09' THEN TIMESTAMP '2022-04-15 10:00:00' ELSE ts END AS ts)
  FROM items_raw),
{clean_items("items_then", "items_raw")}, {clean_items("items_now", "items_moved")}, {clean_opts("opts", "opts_raw")},
{order_fact("fact_then", "items_then", "opts")}, {order_fact("fact_now", "items_now", "opts")}"""


def stored_counts() -> str:
    """Rows per table of a daily run."""
    layers = {
        "ingest": {"order_items": "items_keyed", "order_item_options": "opts_keyed", "date_dim": "cal_raw"},
        "clean": {"order_items": "items", "order_item_options": "opts",
                  "date_dim": "(SELECT * FROM cal_numbered WHERE number % 50 <> 0)"},
        "dimensions": {"dim_date": "days", "dim_customer": "cust", "dim_restaurant": "(SELECT DISTINCT rest FROM items)",
                       "dim_menu_item": "(SELECT DISTINCT item, category FROM items WHERE item IS NOT NULL)"},
        "fact": {"fact_orders": "fact"},
        "metrics": {"gold_clv_snapshot": "grid",
                    "gold_clv_daily_stats": "(SELECT DISTINCT date_key, clv_tier FROM clv WHERE clv_tier <> 'Pre-Activity')",
                    "gold_rfm_segments": "rfm_measures", "gold_churn_indicators": "churn_sums",
                    "gold_sales_daily": "daily", "gold_sales_weekly": "weekly", "gold_sales_monthly": "monthly",
                    "gold_loyalty_comparison": "(SELECT DISTINCT segment FROM labelled)", "gold_location_perf": "places",
                    "gold_upsell_summary": "upsell_counts", "gold_upsell_top_options": "top_options"},
    }
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, 'SUCCESS' AS overall_status, '{table}' AS table_name, 'SUCCESS' AS status, "
        f"count(*) AS row_count FROM {source}"
        for layer, tables in layers.items() for table, source in tables.items())


def profile(source: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) AS row_count, count(*) - count(nullif({expr}, '')) AS null_count, "
        f"{pct2(f'''count(nullif({expr}, ''))''', 'count(*)')} AS filled_pct, "
        f"count(DISTINCT nullif({expr}, '')) AS distinct_count FROM {source}"
        for name, expr in columns.items())


ITEM_COLUMNS = {
    "APP_NAME": "app", "RESTAURANT_ID": "rest",
    "CREATION_TIME_UTC": "(strftime(ts, '%Y-%m-%dT%H:%M:%S') || ts_end)",
    "ORDER_ID": "order_id", "USER_ID": "user_id", "PRINTED_CARD_NUMBER": "card",
    "IS_LOYALTY": "CAST(loyal AS VARCHAR)", "CURRENCY": "'USD'", "LINEITEM_ID": "line_id",
    "ITEM_CATEGORY": "category", "ITEM_NAME": "item", "ITEM_PRICE": "CAST(price_c AS VARCHAR)",
    "ITEM_QUANTITY": "CAST(qty AS VARCHAR)",
}


def share(expr: str, name: str, source: str, count_name: str = "row_count", digits: int = 2, tail: str = "") -> str:
    percent = pct2 if digits == 2 else pct1
    return (f"SELECT {expr} AS {name}, count(*) AS {count_name}, "
            f"{percent('count(*)', f'(SELECT count(*) FROM {source})')} AS pct FROM {source} GROUP BY 1 {tail}")


def quantile(whole: str, percent: int, unit: int = 1) -> str:
    """Interpolated quantile of whole numbers (each worth 1/unit), exact up to the last division."""
    values = f"list_sort(list({whole}) FILTER (({whole}) IS NOT NULL))"
    at = f"((count({whole}) - 1) * {percent})"
    low, high = f"{values}[{at} // 100 + 1]", f"{values}[({at} + 99) // 100 + 1]"
    return f"CAST({low} * (100 - {at} % 100) + {high} * ({at} % 100) AS DOUBLE) / {100 * unit}"


def median(whole: str, unit: int = 1) -> str:
    return quantile(whole, 50, unit)


def tenths(x: str) -> str:
    return f"CAST(round({x} * 10) AS BIGINT)"


FACT_COLUMNS = f"""order_id, user_id, rest AS restaurant_id, order_date, strftime(ts, '%Y-%m-%d %H:%M:%S') AS order_datetime,
  {big('order_hour')} AS order_hour, {big('year(order_date)')} AS order_year, {big('month(order_date)')} AS order_month,
  {big('week(order_date)')} AS order_week, strftime(order_date, '%Y-%m') AS order_year_month, item_count,
  {usd('item_c')} AS total_item_revenue, {usd('opt_c')} AS total_option_revenue, {usd('total_c')} AS total_revenue,
  paid > 0 AS has_paid_options, paid AS paid_option_count, loyal AS is_loyalty, user_id IS NULL AS is_anonymous"""

CUSTOMER_COLUMNS = f"""user_id, first_order_date, last_order_date,
  {big("date_diff('day', first_order_date, last_order_date)")} AS tenure_days, total_orders,
  {usd('spend_c')} AS total_spend, {avg2('spend_c', 'total_orders')} AS avg_order_value, is_loyalty,
  place AS primary_restaurant_id, clv_tier"""

DATE_COLUMNS = f"""date_key, {big('year(date_key)')} AS year, {big('month(date_key)')} AS month,
  {big('day(date_key)')} AS day_of_month, {big('week(date_key)')} AS week, {big('dayofweek(date_key) + 1')} AS day_of_week,
  dayname(date_key) AS day_name, dayofweek(date_key) IN (0, 6) AS is_weekend, holiday_name,
  holiday_name IS NOT NULL AS is_holiday"""

MENU_COLUMNS = f"""item AS item_name, category AS item_category, count(DISTINCT order_id) AS total_orders_sold,
  {big('sum(qty)')} AS total_quantity_sold, {usd('sum(rev_c)')} AS total_revenue,
  {avg2('sum(price_c)', 'count(*)')} AS avg_price, {usd('min(price_c)')} AS min_price, {usd('max(price_c)')} AS max_price,
  min(order_date) AS first_sold_date, max(order_date) AS last_sold_date"""

SALES_COLUMNS = f"""restaurant_id, order_count, unique_customers, {usd('total_c')} AS total_revenue,
  {avg2('total_c', 'order_count')} AS avg_order_value, loyalty_orders"""

LOYALTY_COLUMNS = f"""segment, customer_count, order_count, {usd('total_c')} AS total_revenue, avg_spend_per_order,
  avg_orders_per_customer, avg_customer_spend, repeat_customer_rate_pct, option_attach_rate_pct"""

TOP_OPTION_COLUMNS = f"option_group_name, option_name, attach_count, {usd('c')} AS total_revenue, avg_price"

RFM_COLUMNS = f"""user_id, is_loyalty, {big('recency')} AS recency_days, frequency, {usd('monetary_c')} AS monetary,
  r AS r_score, f AS f_score, m AS m_score, CAST(r AS VARCHAR) || f || m AS rfm_score, segment"""

CLV_DAYS = f"""
SELECT date_key, clv_tier, {big('year(date_key)')} AS snapshot_year, count(*) AS customers,
  {usd('min(spend_c)')} AS min_spend, {usd('max(spend_c)')} AS max_spend, {usd('sum(spend_c)')} AS spend,
  {big('sum(orders)')} AS orders, {usd('sum(rev_c)')} AS revenue, {big('sum(n)')} AS new_orders,
  {big("sum(date_diff('day', first_order_date, date_key))")} AS age_days, count(*) FILTER (rev_c > 0) AS active
FROM clv GROUP BY 1, 2, 3"""

CLEAN_COLUMNS = f"""
SELECT app AS "APP_NAME", rest AS "RESTAURANT_ID", strftime(ts, '%Y-%m-%d %H:%M:%S') AS "CREATION_TIME_UTC",
  order_id AS "ORDER_ID", user_id AS "USER_ID", card AS "PRINTED_CARD_NUMBER", loyal AS "IS_LOYALTY", 'USD' AS "CURRENCY",
  line_id AS "LINEITEM_ID", category AS "ITEM_CATEGORY", item AS "ITEM_NAME", {usd('price_c')} AS "ITEM_PRICE",
  {big('qty')} AS "ITEM_QUANTITY", order_date, {big('order_hour')} AS order_hour, {usd('rev_c')} AS line_item_revenue,
  user_id IS NULL AS is_anonymous, price_c = 0 AS is_zero_price_flag FROM items"""

QUARTILES = ", ".join(
    f"{quantile('spend_c', p, 100)} AS {n}" for n, p in (("p25_spend", 25), ("median_spend", 50), ("p75_spend", 75)))

_customer = "(SELECT user_id FROM cust ORDER BY spend_c DESC, user_id LIMIT 1)"
_churn_order = "CASE tag WHEN 'Active' THEN 0 WHEN 'Cooling Off' THEN 1 WHEN 'At Risk' THEN 2 ELSE 3 END"


def rfm_medians(condition: str) -> str:
    return (f"SELECT {median('frequency')} AS median_frequency, {median('monetary_c', 100)} AS median_monetary, "
            f"{median('recency')} AS median_recency, count(*) AS customers FROM rfm WHERE {condition}")


def churn_breakdown(tag: str) -> str:
    return (f"SELECT {tag}, count(*) AS customer_count, {median('days_since_last_order')} AS median_days_since_last, "
            f"{median(tenths('avg_gap_days'), 10)} AS median_avg_gap, {median('total_orders')} AS median_orders, "
            f"{median(tenths('spend_change_pct'), 10)} AS median_spend_change_pct FROM churn GROUP BY 1")


def trend(label: str, source: str, cents: str) -> str:
    return (f"SELECT {label} AS period, {usd(f'sum({cents})')} AS total_revenue, {big('sum(order_count)')} AS order_count "
            f"FROM {source} GROUP BY 1")


ORACLES: dict[str, str] = {
    "ingest_tables": q(
        "SELECT 'order_items' AS table_name, '2026-01-01' AS ingestion_date, count(*) AS row_count FROM items_keyed "
        "UNION ALL SELECT 'order_item_options', '2026-01-01', count(*) FROM opts_keyed "
        "UNION ALL SELECT 'date_dim', '2026-01-01', count(*) FROM cal_raw", RAW_KEYED),
    "clean_order_items": q(CLEAN_COLUMNS),
    "clean_damaged_items": q(CLEAN_COLUMNS.replace(big("order_hour"), "CAST(order_hour AS DOUBLE)"), DAMAGED),
    "clean_options": q(f"""
SELECT order_id AS "ORDER_ID", line_id AS "LINEITEM_ID", grp AS "OPTION_GROUP_NAME", opt AS "OPTION_NAME",
  {usd('price_c')} AS "OPTION_PRICE", {big('qty')} AS "OPTION_QUANTITY", price_c > 0 AS is_paid_option,
  {usd('price_c * qty')} AS option_revenue FROM opts"""),
    "clean_calendar": q(f"""
SELECT d AS date_key, strftime(d, '%d-%m-%Y') AS date_key_raw, {big('year(d)')} AS year, {big('month(d)')} AS month,
  {big('week(d)')} AS week, dayname(d) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
  CASE number % 30 WHEN 0 THEN true WHEN 1 THEN NULL ELSE false END AS is_holiday,
  CASE WHEN number % 30 = 0 THEN 'Labor Day' END AS holiday_name
FROM cal_numbered WHERE number % 50 <> 0""", RAW),
    "item_stage_counts": q(stage_lines("item_counts", ITEM_STAGES), STAGES),
    "damaged_stage_counts": q(stage_lines("item_counts", ITEM_STAGES), DAMAGED),
    "option_stage_counts": q(stage_lines("option_counts", OPTION_STAGES), STAGES),
    "upsert_items": q(DIGEST.format("merged"), UPSERTED),
    "ingest_stream": q(DIGEST.format("merged"), UPSERTED),
    "rollback_items": q(DIGEST.format("items_keyed"), RAW_KEYED),
    "reload_months": q(
        f"SELECT strftime(order_date, '%Y-%m') AS order_year_month, count(*) AS orders, {usd('sum(total_c)')} AS revenue "
        "FROM fact GROUP BY 1", RELOADED),
    "reload_dependents": q(" UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {part} AS part, count(*) AS groups, {big(f'sum({orders})')} AS orders, "
        f"{big(f'sum({customers})')} AS customers, {usd(f'sum({cents})')} AS revenue FROM {source} GROUP BY 2"
        for table, part, orders, customers, cents, source in (
            ("gold_sales_daily", "CAST(order_date AS VARCHAR)", "order_count", "unique_customers", "rev_c", "daily"),
            ("gold_sales_weekly", "printf('%d-%02d', order_year, order_week)", "order_count", "unique_customers", "total_c", "weekly"),
            ("gold_sales_monthly", "order_year_month", "order_count", "unique_customers", "total_c", "monthly"),
            ("gold_location_perf", "printf('%s %d', restaurant_id, revenue_rank)", "total_orders", "unique_customers", "total_c", "locations"),
            ("gold_loyalty_comparison", "segment", "order_count", "customer_count", "total_c", "loyalty"))), RELOADED + "," + METRICS),
    "reload_moved_orders": q(" UNION ALL ".join(
        f"SELECT '{state}' AS state, strftime(order_date, '%Y-%m') AS order_year_month, count(*) AS orders, "
        f"{usd('sum(total_c)')} AS revenue FROM {fact} GROUP BY 2"
        for state, fact in (("reloaded", "fact_now"), ("rolled back", "fact_then"))), MOVED),
    "dim_date": q(f"SELECT {DATE_COLUMNS} FROM days LEFT JOIN holidays ON date_key = d"),
    "dim_customer": q(f"SELECT {CUSTOMER_COLUMNS} FROM cust"),
    "dim_restaurant": q(f"""
SELECT restaurant_id, total_orders, {usd('cents')} AS total_revenue, unique_customers,
  {avg2('cents', 'total_orders')} AS avg_order_value, first_order_date, last_order_date, active_days,
  row_number() OVER (ORDER BY cents DESC, restaurant_id) AS revenue_rank FROM (
  SELECT rest AS restaurant_id, count(DISTINCT order_id) AS total_orders, CAST(sum(rev_c) AS BIGINT) AS cents,
    count(DISTINCT user_id) AS unique_customers, min(order_date) AS first_order_date,
    max(order_date) AS last_order_date, count(DISTINCT order_date) AS active_days FROM items GROUP BY 1)"""),
    "dim_menu_item": q(f"SELECT {MENU_COLUMNS} FROM items WHERE item IS NOT NULL GROUP BY 1, 2"),
    "fact_orders": q(f"SELECT {FACT_COLUMNS} FROM fact"),
    "fact_profile": q(f"""
SELECT count(*) AS orders, count(DISTINCT user_id) AS customers, {usd('sum(total_c)')} AS revenue,
  {pct1('count(*) FILTER (user_id IS NULL)', 'count(*)')} AS anonymous_pct FROM fact"""),
    "clv_days": q(CLV_DAYS),
    "clv_days_of_purchases": q(CLV_DAYS, PURCHASES),
    "rfm_segments_of_purchases": q(f"SELECT {RFM_COLUMNS} FROM rfm", PURCHASES),
    "churn_indicators_of_purchases": q("SELECT * FROM churn", PURCHASES),
    "clv_customers": q(f"""
SELECT user_id, clv_tier, count(*) AS days, min(date_key) AS first_day, max(date_key) AS last_day,
  {usd('max(spend_c)')} AS max_spend, max(orders) AS max_orders, {usd('sum(rev_c)')} AS revenue,
  count(*) FILTER (rev_c > 0) AS active_days FROM clv GROUP BY 1, 2"""),
    "rfm_segments": q(f"SELECT {RFM_COLUMNS} FROM rfm"),
    "churn_indicators": q("SELECT * FROM churn"),
    "sales_daily": q(f"""
SELECT order_date, restaurant_id, item_category, order_count, unique_customers, {usd('rev_c')} AS total_item_revenue,
  loyalty_line_items, {avg2('rev_c', 'order_count')} AS avg_order_revenue, {big('year(order_date)')} AS snapshot_year
FROM daily"""),
    "sales_weekly": q(f"SELECT order_year, order_week, {SALES_COLUMNS} FROM weekly"),
    "sales_weekly_iso": q(f"""
SELECT order_year, order_week, {SALES_COLUMNS} FROM (
  SELECT isoyear(order_date) AS order_year, week(order_date) AS order_week, rest AS restaurant_id,
    count(*) AS order_count, count(DISTINCT user_id) AS unique_customers, CAST(sum(total_c) AS BIGINT) AS total_c,
    count(*) FILTER (loyal) AS loyalty_orders FROM fact GROUP BY 1, 2, 3)"""),
    "sales_monthly": q(f"""
SELECT order_year, order_month, order_year_month, {SALES_COLUMNS}, {usd('opt_c')} AS total_option_revenue FROM monthly"""),
    "loyalty_comparison": q(f"SELECT {LOYALTY_COLUMNS} FROM loyalty"),
    "location_perf": q(f"""
SELECT restaurant_id, total_orders, unique_customers, {usd('total_c')} AS total_revenue,
  {avg2('total_c', 'total_orders')} AS avg_order_value, active_weeks, first_order_date, last_order_date,
  CAST({div('total_orders * 10', 'active_weeks')} AS DOUBLE) / 10 AS orders_per_week,
  {avg2('total_c', 'active_weeks')} AS revenue_per_week, {pct1('loyals', 'total_orders')} AS loyalty_order_pct,
  repeats AS repeat_customer_count, retention_rate_pct, revenue_rank, orders_rank, customers_rank FROM locations"""),
    "upsell_summary": q("SELECT * FROM upsell"),
    "upsell_top_options": q(f"SELECT {TOP_OPTION_COLUMNS} FROM top_options"),
    "rep_kpis": q(f"""
SELECT {usd('sum(total_c)')} AS total_revenue, {big('sum(order_count)')} AS total_orders,
  {big("sum(customer_count) FILTER (segment <> 'Anonymous')")} AS total_customers,
  {pct1("sum(customer_count) FILTER (segment = 'Loyalty')", "sum(customer_count) FILTER (segment <> 'Anonymous')")} AS loyalty_pct,
  (SELECT upsell_share_of_revenue_pct FROM upsell) AS upsell_share_pct FROM loyalty"""),
    "rep_kpis_distinct": q(f"""
SELECT count(*) AS total_customers, count(*) FILTER (loyal) AS loyalty_customers,
  {pct1('count(*) FILTER (loyal)', 'count(*)')} AS loyalty_pct
FROM (SELECT user_id, bool_or(loyal) AS loyal FROM known GROUP BY 1)"""),
    "clv_daily_stats": q(f"""
SELECT date_key, clv_tier, count(*) AS customer_count, {QUARTILES} FROM clv
WHERE clv_tier <> 'Pre-Activity' GROUP BY 1, 2"""),
    "rep_clv_by_day": q(f"""
SELECT date_key, clv_tier, count(*) AS customer_count, {QUARTILES} FROM clv
WHERE clv_tier IN ('High', 'Medium', 'Low') GROUP BY 1, 2"""),
    "rep_clv_latest_tiers": q("""
SELECT clv_tier, date_key, customer_count FROM (
  SELECT date_key, clv_tier, count(*) AS customer_count,
    row_number() OVER (PARTITION BY clv_tier ORDER BY date_key DESC) AS rn
  FROM clv WHERE clv_tier IN ('High', 'Medium', 'Low') GROUP BY 1, 2) WHERE rn = 1"""),
    # The sketched quartiles differ from the exact ones within a stated bound of ranks; the query tests it row by row.
    "rep_clv_range_sketched": q("""
SELECT strftime(date_key, '%Y-%m') AS period, clv_tier, count(*) AS customer_days, true AS p25_spend_within_bound,
  true AS median_spend_within_bound, true AS p75_spend_within_bound FROM clv WHERE clv_tier <> 'Pre-Activity' GROUP BY 1, 2"""),
    "sales_customers_rollup": q(" UNION ALL ".join(f"""
SELECT '{grain}' AS grain, period, restaurant_id, count(user_id) AS customers, count(user_id) FILTER (again) AS customers_again FROM (
  SELECT a.*, EXISTS (SELECT 1 FROM {grain}_visits b WHERE b.restaurant_id = a.restaurant_id AND b.user_id = a.user_id
                      AND b.period = CAST(a.period - INTERVAL 1 {grain} AS DATE)) AS again
  FROM {grain}_visits a) GROUP BY 1, 2, 3""" for grain in ("week", "month")), BASE + "".join(f""",
{grain}_visits AS (
  SELECT DISTINCT CAST(date_trunc('{grain}', order_date) AS DATE) AS period, rest AS restaurant_id, user_id FROM fact)"""
        for grain in ("week", "month"))),
    "rep_clv_kpis": q(f"""
SELECT count(DISTINCT user_id) AS customers_scored, min(date_key) AS earliest_date, max(date_key) AS latest_date,
  {usd('max(spend_c)')} AS max_clv,
  (SELECT {median('spend_c', 100)} FROM clv WHERE date_key = (SELECT max(date_key) FROM clv)) AS median_clv_latest
FROM clv"""),
    "rep_top_customers": q(f"""
SELECT user_id, {usd('spend_c')} AS total_spend, total_orders, clv_tier,
  {big("date_diff('day', first_order_date, last_order_date)")} AS tenure_days
FROM cust ORDER BY spend_c DESC, user_id LIMIT 50"""),
    "rep_customer_profile": q(f"SELECT {CUSTOMER_COLUMNS} FROM cust WHERE user_id = {_customer}"),
    "rep_trajectory": q(f"""
SELECT date_key, {usd('spend_c')} AS cumulative_spend, {usd('rev_c')} AS daily_revenue, clv_tier,
  rev_c > 0 AS is_order_day FROM clv WHERE user_id = {_customer}"""),
    "rep_rfm_medians": q(rfm_medians("true")),
    "rep_rfm_medians_loyalty": q(rfm_medians("is_loyalty")),
    "rep_segment_loyalty": q("SELECT segment, loyalty_label, count(*) AS customer_count FROM rfm GROUP BY 1, 2"),
    "rep_segment_share": q(share("segment", "segment", "rfm", "customer_count", 1)),
    "rep_segment_share_other": q(
        share("segment", "segment", "rfm_other", "customer_count", 1),
        BASE + ", rfm_other AS (SELECT * FROM rfm WHERE NOT is_loyalty)"),
    "dim_profiles": q("""
SELECT 'dim_customer' AS table_name, unnest(['rows', 'high tier', 'medium tier', 'low tier', 'loyalty']) AS measure,
  unnest([count(*), count(*) FILTER (clv_tier = 'High'), count(*) FILTER (clv_tier = 'Medium'),
          count(*) FILTER (clv_tier = 'Low'), count(*) FILTER (is_loyalty)]) AS row_count FROM cust
UNION ALL SELECT 'dim_date', unnest(['rows', 'week-ends', 'holidays']),
  unnest([count(*), count(*) FILTER (dayofweek(date_key) IN (0, 6)), count(*) FILTER (holiday_name IS NOT NULL)])
  FROM days LEFT JOIN holidays ON date_key = d
UNION ALL SELECT 'gold_rfm_segments', unnest(['rows', 'in window']), unnest([count(*), count(*) FILTER (frequency > 0)])
FROM rfm"""),
    "rep_segment_sample": q(f"SELECT {RFM_COLUMNS} FROM rfm ORDER BY md5('42:' || user_id), user_id LIMIT 60"),
    "rep_churn_sample": q(
        "SELECT * FROM churn WHERE spend_change_pct IS NOT NULL ORDER BY md5('42:' || user_id), user_id LIMIT 60"),
    "rep_score_heat": q("SELECT r AS r_score, f AS f_score, count(*) AS customer_count FROM rfm GROUP BY 1, 2"),
    "rep_segment_leaderboard": q(f"""
SELECT segment, loyalty_label, count(*) AS customer_count, {usd('sum(monetary_c)')} AS total_monetary,
  {median('recency')} AS median_recency, {median('frequency')} AS median_frequency,
  {median('monetary_c', 100)} AS median_monetary FROM rfm GROUP BY 1, 2"""),
    "rep_churn_tags": q(" UNION ALL ".join(
        f"SELECT '{c}' AS method, {c} AS tag, count(*) AS customer_count, "
        f"{pct1('count(*)', '(SELECT count(*) FROM churn)')} AS pct FROM churn GROUP BY 2"
        for c in ("churn_tag", "churn_tag_personal"))),
    "rep_churn_breakdown": q(churn_breakdown("churn_tag")),
    "rep_churn_breakdown_personal": q(churn_breakdown("churn_tag_personal")),
    "rep_churn_alerts": q("""
SELECT *, (SELECT count(*) FROM churn WHERE days_since_last_order > 45) AS alert_count
FROM churn WHERE days_since_last_order > 45 ORDER BY days_since_last_order DESC, user_id LIMIT 200"""),
    "rep_sales_kpis": q(f"""
SELECT {usd('sum(total_c)')} AS total_revenue, {big('sum(order_count)')} AS total_orders,
  count(DISTINCT order_year_month) AS months_observed FROM monthly"""),
    "rep_restaurants": q("SELECT DISTINCT restaurant_id FROM monthly"),
    "rep_trend_monthly": q(trend("order_year_month", "monthly", "total_c")),
    "rep_trend_weekly": q(trend("format('{:d}-W{:02d}', order_year, order_week)", "weekly", "total_c")),
    "rep_trend_daily": q(trend("CAST(order_date AS VARCHAR)", "daily", "rev_c")),
    "rep_trend_monthly_restaurant": q(
        trend("order_year_month", "monthly", "total_c").replace("GROUP BY", "WHERE restaurant_id = 'R3' GROUP BY")),
    "rep_top_categories": q(f"""
SELECT item_category, {usd('sum(rev_c)')} AS total_revenue, {big('sum(order_count)')} AS order_count
FROM daily GROUP BY 1 ORDER BY sum(rev_c) DESC, item_category LIMIT 20"""),
    "rep_loyalty": q(f"""
SELECT {LOYALTY_COLUMNS}, {pct1('total_c', '(SELECT sum(total_c) FROM loyalty)')} AS revenue_share_pct,
  (SELECT round(max(CASE WHEN segment = 'Loyalty' THEN repeat_customer_rate_pct END)
    - max(CASE WHEN segment = 'Non-Loyalty' THEN repeat_customer_rate_pct END), 1) FROM loyalty) AS repeat_rate_gap,
  CAST(CASE segment WHEN 'Loyalty' THEN 0 WHEN 'Non-Loyalty' THEN 1 ELSE 2 END AS BIGINT) AS position FROM loyalty"""),
    "rep_locations": q(f"""
SELECT revenue_rank, right(restaurant_id, 8) AS restaurant_short, restaurant_id, {usd('total_c')} AS total_revenue,
  {pct1('total_c', '(SELECT sum(total_c) FROM locations)')} AS revenue_share_pct, total_orders, unique_customers,
  repeats AS repeat_customer_count, retention_rate_pct, {avg2('total_c', 'total_orders')} AS avg_order_value,
  CAST({div('total_orders * 10', 'active_weeks')} AS DOUBLE) / 10 AS orders_per_week,
  {pct1('loyals', 'total_orders')} AS loyalty_order_pct FROM locations"""),
    "rep_location_kpis": q(f"""
SELECT count(*) AS restaurants, {usd('sum(total_c)')} AS total_revenue,
  {pct1('max(total_c) FILTER (revenue_rank = 1)', 'sum(total_c)')} AS top_location_share_pct,
  CAST({div('sum(CAST(round(retention_rate_pct * 10) AS BIGINT))', 'count(retention_rate_pct)')} AS DOUBLE) / 10
    AS avg_retention_pct FROM locations"""),
    "rep_top_options": q(f"""
SELECT {TOP_OPTION_COLUMNS}, substr(option_group_name, 1, 30) || ' / ' || option_name AS option_display
FROM top_options ORDER BY c DESC, option_group_name, option_name LIMIT 15"""),
    "rep_plotted_options": q(f"""
SELECT {TOP_OPTION_COLUMNS}, substr(option_group_name, 1, 30) || ' / ' || option_name AS option_display
FROM top_options ORDER BY c DESC, option_group_name, option_name LIMIT 100"""),
    "sql_over_views": q(f"""
SELECT clv_tier, count(*) AS orders, {usd('sum(total_c)')} AS revenue
FROM fact JOIN cust ON fact.user_id = cust.user_id GROUP BY 1"""),
    "aud_profile_items": q(profile("items_raw", ITEM_COLUMNS), RAW),
    # The sketched counts differ from the exact ones within a stated bound; the query tests it column by column.
    "aud_profile_items_sketched": q(
        "SELECT column_name, row_count, null_count, filled_pct, true AS distinct_within_bound FROM ("
        + profile("items_raw", ITEM_COLUMNS) + ")", RAW),
    "aud_profile_options": q(profile("opts_raw", {
        "ORDER_ID": "order_id", "LINEITEM_ID": "line_id", "OPTION_GROUP_NAME": "grp", "OPTION_NAME": "opt",
        "OPTION_PRICE": "CAST(price_c AS VARCHAR)", "OPTION_QUANTITY": "'1'"}), RAW),
    "aud_price_percentiles": q(
        "SELECT count(*) FILTER (price_c = 0) AS zeros, count(*) FILTER (price_c < 0) AS negatives, "
        "count(*) FILTER (price_c > 5000) AS outliers, "
        f"{usd('min(price_c)')} AS min_value, {usd('max(price_c)')} AS max_value, "
        + ", ".join(f"{quantile('price_c', p, 100)} AS p{p}" for p in PERCENTILES) + " FROM items_raw", RAW),
    "aud_top_restaurants": q(share('rest', '"RESTAURANT_ID"', "items_raw", tail="ORDER BY row_count DESC, 1 LIMIT 10"), RAW),
    "aud_apps": q(share('app', '"APP_NAME"', "items_raw"), RAW),
    "aud_option_prices": q(share(usd('price_c'), '"OPTION_PRICE"', "opts_raw"), RAW),
    "aud_option_groups": q(share('grp', '"OPTION_GROUP_NAME"', "opts_raw", tail="ORDER BY row_count DESC, 1 LIMIT 15"), RAW),
    "aud_quantities": q(share(ranges("qty", QUANTITY_RANGES), "quantity_range", "items_raw"), RAW),
    "aud_item_keys": q("""
SELECT count(*) AS row_count, count(DISTINCT (order_id, line_id)) AS key_count,
  count(*) - count(DISTINCT (order_id, line_id)) AS surplus_count FROM items_raw""", RAW),
    "aud_option_keys": q("""
SELECT count(*) AS row_count, count(DISTINCT (order_id, line_id, grp, opt)) AS key_count,
  count(*) - count(DISTINCT (order_id, line_id, grp, opt)) AS surplus_count FROM opts_raw""", RAW),
    "aud_duplicates": q(f"""
SELECT order_id AS "ORDER_ID", line_id AS "LINEITEM_ID", grp AS "OPTION_GROUP_NAME", opt AS "OPTION_NAME",
  {usd('price_c')} AS "OPTION_PRICE", CAST(1 AS BIGINT) AS "OPTION_QUANTITY", count(*) AS copies
FROM opts_raw GROUP BY ALL HAVING count(*) > 1""", RAW),
    "aud_dependency": q(" UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) AS key_count, count(*) FILTER (n > 1) AS violations "
        f"FROM (SELECT order_id, count(DISTINCT {expr}) AS n FROM items_raw GROUP BY 1)"
        for name, expr in (("USER_ID", "user_id"), ("RESTAURANT_ID", "rest"), ("CREATION_TIME_UTC", "ts"),
                           ("APP_NAME", "app"), ("IS_LOYALTY", "loyal"))), RAW),
    "aud_orphans": q("""
SELECT count(*) FILTER (in_items AND in_opts) AS orders_in_both,
  count(*) FILTER (in_items AND NOT in_opts) AS orders_without_options,
  count(*) FILTER (NOT in_items) AS option_orders_without_items,
  (SELECT count(*) FROM opts o WHERE NOT EXISTS (
    SELECT 1 FROM items i WHERE i.order_id = o.order_id AND i.line_id = o.line_id)) AS orphan_option_rows
FROM (SELECT coalesce(i.order_id, o.order_id) AS id, i.order_id IS NOT NULL AS in_items, o.order_id IS NOT NULL AS in_opts
  FROM (SELECT DISTINCT order_id FROM items) i FULL JOIN (SELECT DISTINCT order_id FROM opts) o USING (order_id))"""),
    "aud_items_per_order": q(
        share(ranges("n", ITEMS_PER_ORDER), "size_range", "sizes", "groups", 1),
        RAW + ", sizes AS (SELECT order_id, count(*) AS n FROM items_raw GROUP BY 1)"),
    "aud_options_per_line": q(
        share(ranges("n", OPTIONS_PER_LINE), "size_range", "sizes", "groups", 1),
        RAW + ", sizes AS (SELECT order_id, line_id, count(*) AS n FROM opts_raw GROUP BY 1, 2)"),
    "aud_order_frequency": q(
        f"SELECT order_range, count(*) AS customers, {pct1('count(*)', '(SELECT count(*) FROM sizes)')} AS pct, "
        f"{pct1('sum(count(*)) OVER (ORDER BY min(n))', '(SELECT count(*) FROM sizes)')} AS cumulative_pct FROM ("
        f"SELECT n, {ranges('n', ORDERS_PER_CUSTOMER)} AS order_range FROM sizes) GROUP BY 1",
        RAW + ", sizes AS (SELECT user_id, count(DISTINCT order_id) AS n FROM items_raw WHERE user_id IS NOT NULL GROUP BY 1)"),
    "aud_hours": q(share(big("hour(ts)"), "order_hour", "items_raw", digits=1), RAW),
    "aud_yearly_volume": q(f"""
SELECT *, {pct1('row_count - lag(row_count) OVER (ORDER BY order_year)', 'lag(row_count) OVER (ORDER BY order_year)')} AS growth_pct
FROM ({share(big("year(ts)"), "order_year", "items_raw", digits=1)})""", RAW),
    "aud_yearly_revenue": q(f"""
SELECT {big('year(order_date)')} AS order_year, {usd('sum(rev_c)')} AS revenue, count(DISTINCT order_id) AS orders,
  {avg2('sum(rev_c)', 'count(DISTINCT order_id)')} AS revenue_per_order FROM items GROUP BY 1"""),
    "aud_impact": q(f"""
SELECT n AS raw_rows, k AS kept_rows, n - k AS removed_rows, {usd('c')} AS raw_revenue, {usd('kc')} AS kept_revenue,
  {usd('c - kc')} AS removed_revenue, {pct1('c - kc', 'c')} AS removed_revenue_pct
FROM (SELECT count(*) AS n, sum(price_c * qty) AS c FROM items_raw),
  (SELECT count(*) AS k, sum(price_c * qty) AS kc FROM items_kept)"""),
    "aud_card_consistency": q("""
SELECT CASE WHEN loyal THEN 'TRUE' ELSE 'FALSE' END AS "IS_LOYALTY", card IS NOT NULL AS has_card, count(*) AS row_count
FROM items_raw GROUP BY 1, 2""", RAW),
    "aud_shared_cards": q("""
SELECT card AS "PRINTED_CARD_NUMBER", count(DISTINCT user_id) AS customers FROM items_raw
WHERE card IS NOT NULL GROUP BY 1 HAVING count(DISTINCT user_id) > 1""", RAW),
    "aud_damaged_shared_cards": q("""
SELECT card AS "PRINTED_CARD_NUMBER", count(DISTINCT user_id) AS customers FROM damaged
WHERE card IS NOT NULL GROUP BY 1 HAVING count(DISTINCT user_id) > 1""", DAMAGED),
    "aud_anonymous_cards": q(
        share("card IS NOT NULL", "has_card", "nobody", digits=1),
        RAW + ", nobody AS (SELECT * FROM items_raw WHERE user_id IS NULL)"),
    "gate_rows": q(" UNION ALL ".join(
        f"SELECT '{table}' AS table_name, input AS raw_rows, after_dedupe AS clean_rows, "
        f"{pct2('after_dedupe', 'input')} AS retained_pct, "
        f"CASE WHEN {pct2('after_dedupe', 'input')} BETWEEN 95 AND 100 THEN 'OK' ELSE 'FLAGGED' END AS status FROM {counts}"
        for table, counts in (("order_items", "item_counts"), ("order_item_options", "option_counts"))), STAGES),
    "gate_volume": q(f"""
SELECT order_year_month, fact_rows, previous_rows, change_pct,
  CASE WHEN change_pct < -10 THEN 'ANOMALY' ELSE 'OK' END AS status FROM (
  SELECT *, {pct2('fact_rows - previous_rows', 'previous_rows')} AS change_pct FROM (
    SELECT strftime(order_date, '%Y-%m') AS order_year_month, count(*) AS fact_rows,
      CAST(lag(count(*)) OVER (ORDER BY strftime(order_date, '%Y-%m')) AS DOUBLE) AS previous_rows FROM fact GROUP BY 1))"""),
    "var_calendar_extras": q(f"""
SELECT {DATE_COLUMNS}, monthname(date_key) AS month_name, {big('quarter(date_key)')} AS quarter,
  {big('isodow(date_key)')} AS day_of_week_num FROM days LEFT JOIN holidays ON date_key = d"""),
    "var_menu_item_key": q(f"""
SELECT sha256(item || chr(31) || category) AS item_key, {MENU_COLUMNS} FROM items WHERE item IS NOT NULL
GROUP BY item, category"""),
    "var_fact_extras": q(f"""
SELECT {FACT_COLUMNS}, CASE WHEN order_hour <= 5 THEN 'Night' WHEN order_hour <= 11 THEN 'Morning'
  WHEN order_hour <= 17 THEN 'Afternoon' ELSE 'Evening' END AS hour_bucket, app AS app_name FROM fact"""),
    "var_clv_percent_rank": q(f"""
SELECT date_key AS snapshot_date, CASE WHEN pr >= 0.8 THEN 'High' WHEN pr >= 0.2 THEN 'Medium' ELSE 'Low' END AS clv_tier,
  count(*) AS customers, {usd('sum(spend_c)')} AS spend, {big('sum(orders)')} AS orders,
  {big("sum(date_diff('day', first_order_date, date_key))")} AS age_days,
  count(*) FILTER (date_diff('day', last_day, date_key) <= 90) AS active
FROM (SELECT *, percent_rank() OVER (PARTITION BY date_key ORDER BY spend_c) AS pr FROM clv_sums) GROUP BY 1, 2"""),
    "var_rfm_lifetime": q(f"""
SELECT user_id, last_day AS last_order_date, {big('recency')} AS recency_days, frequency_all AS frequency,
  {usd('monetary_all_c')} AS monetary, r AS r_score, f_all AS f_score, m_all AS m_score,
  CASE WHEN r >= 4 AND f_all >= 4 AND m_all >= 4 THEN 'VIP' WHEN f_all >= 4 AND m_all >= 3 THEN 'Loyal'
    WHEN r >= 4 AND f_all <= 2 THEN 'New Customer' WHEN r >= 3 AND f_all >= 2 AND m_all >= 2 THEN 'Promising'
    WHEN r <= 2 AND f_all >= 3 THEN 'At Risk' WHEN r <= 2 AND f_all <= 2 AND m_all <= 2 THEN 'Lost'
    ELSE 'Regular' END AS rfm_segment FROM rfm_scores"""),
    "var_churn_recent_spend": q(f"""
SELECT user_id, n AS total_orders, age AS days_since_last_order,
  {ratio2('oldest - age', 'n - 1')} AS avg_days_between_orders,
  {pct2('recent_c - prior_c', 'prior_c')} AS spend_trend_pct,
  CASE WHEN age <= 30 THEN 'Active' WHEN age <= 45 THEN 'Cooling Off' WHEN age <= 90 THEN 'At Risk' ELSE 'Inactive' END
    AS churn_tag
FROM (SELECT user_id, count(*) AS n, min(age) AS age, max(age) AS oldest,
    coalesce(sum(total_c) FILTER (age < 90), 0) AS recent_c,
    coalesce(sum(total_c) FILTER (age >= 90 AND age < 180), 0) AS prior_c
  FROM (SELECT *, date_diff('day', order_date, (SELECT d FROM today)) AS age FROM known) GROUP BY 1)"""),
    "var_loyalty_lifetime_value": q(f"""
SELECT loyal AS is_loyalty, count(*) AS customer_count, {big('sum(n)')} AS total_orders, {usd('sum(c)')} AS total_revenue,
  {avg2('sum(c)', 'count(*)')} AS avg_clv, {avg2('sum(c)', 'sum(n)')} AS avg_order_value,
  {pct2('count(*) FILTER (n > 1)', 'count(*)')} AS repeat_order_rate,
  {ratio2('sum(n)', 'count(*)')} AS avg_orders_per_customer
FROM (SELECT user_id, bool_or(loyal) AS loyal, count(*) AS n, sum(total_c) AS c FROM known GROUP BY 1) GROUP BY 1"""),
    "var_upsell_by_attachment": q(f"""
SELECT paid > 0 AS has_paid_options, count(*) AS order_count, {usd('sum(total_c)')} AS total_revenue,
  {avg2('sum(total_c)', 'count(*)')} AS avg_order_value, {usd('sum(opt_c)')} AS total_option_revenue,
  {pct2('sum(opt_c)', 'sum(total_c)')} AS option_revenue_pct,
  {ratio2('sum(paid)', 'count(*) FILTER (paid > 0)')} AS avg_paid_options_per_order FROM fact GROUP BY 1"""),
    "var_frequent_options": q(f"""
SELECT opt AS option_name, count(*) AS attach_count, {usd('sum(price_c * qty)')} AS total_revenue
FROM opts WHERE price_c > 0 GROUP BY 1 ORDER BY attach_count DESC, option_name LIMIT 20"""),
    "daily_run": q(stored_counts(), BASE_KEYED),
}
