"""For each registered query an independent SQL statement over the same tables.

Written the plain way - distinct counts, unpartitioned windows, cross joins with one-row
parameters - and not the way the operators run.
"""

from __future__ import annotations

import math
import re

REF = "TIMESTAMP '2001-01-01'"
SUBDAY_REF = "TIMESTAMP '2024-01-25'"

TRANSACTIONS = """
tx AS (
  SELECT o_orderdate AS datetime, l_partkey AS product_id,
         l_extendedprice * (1 - l_discount) / l_quantity AS price,
         CAST(l_quantity AS INTEGER) AS qty, o_custkey AS customer_id,
         CASE WHEN l_discount > 0.085 THEN 'PROM_HIST' ELSE '' END AS promotion_id,
         l_suppkey AS store_id, l_orderkey AS po_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

SUBDAY = """
tx AS (
  SELECT ts AS datetime, value AS price, 1 AS qty, user_id AS customer_id,
         '' AS promotion_id, event_id AS po_id
  FROM events WHERE event_type = 'purchase')"""

CUSTOMERS = """
cust AS (
  SELECT c_custkey AS customer_id,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'High Value'
              WHEN 'BUILDING' THEN 'Frequent Shopper' WHEN 'FURNITURE' THEN 'Price Sensitive'
              WHEN 'HOUSEHOLD' THEN 'Occasional' ELSE c_mktsegment END AS customer_taxonomies
  FROM customer)"""

PRODUCTS = """
prod AS (
  SELECT p_partkey AS product_id, p_retailprice AS price,
         CAST(0.60 AS DOUBLE) * p_retailprice AS cogs, p_type AS product_taxonomies
  FROM part)"""

STORES = """
store AS (
  SELECT s_suppkey AS store_id, n_name AS store_taxonomies
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

PROMOTIONS = """
promo AS (
  SELECT v.promotion_id, v.discount, p_partkey AS product_id,
         DATE '2001-01-01' AS start_date, DATE '2001-03-31' AS end_date
  FROM part JOIN (VALUES ('PROM_001', 1, CAST(0.20 AS DOUBLE)),
                         ('PROM_002', 12, CAST(0.15 AS DOUBLE)),
                         ('PROM_003', 25, CAST(0.10 AS DOUBLE)),
                         ('PROM_004', 35, CAST(0.25 AS DOUBLE))) v(promotion_id, part, discount)
       ON p_partkey = v.part)"""


def features(ref: str = REF) -> str:
    return f"""
hist AS (
  SELECT *, CAST(price * qty AS DECIMAL(18,4)) AS revenue FROM tx
  WHERE customer_id IS NOT NULL AND datetime < {ref}),
totals AS (
  SELECT customer_id,
         date_sub('day', max(datetime), {ref}) AS recency,
         count(DISTINCT po_id) FILTER (WHERE datetime >= {ref} - INTERVAL 30 DAY) AS f30,
         CAST(sum(revenue) FILTER (WHERE datetime >= {ref} - INTERVAL 90 DAY) AS DOUBLE) AS m90,
         CAST(sum(revenue) AS DOUBLE) AS spend, count(DISTINCT po_id) AS visits,
         CAST(sum(qty) AS BIGINT) AS items,
         count(*) FILTER (WHERE coalesce(promotion_id, '') <> '') AS promo_lines,
         count(*) AS lines
  FROM hist GROUP BY customer_id),
feat AS (
  SELECT c.customer_id, c.customer_taxonomies,
         coalesce(t.recency, 180) AS recency_days,
         coalesce(t.f30, 0) AS frequency_30d,
         coalesce(t.m90, CAST(0 AS DOUBLE)) AS monetary_90d,
         coalesce(t.spend, CAST(0 AS DOUBLE)) AS total_spend,
         coalesce(t.visits, 0) AS total_visits,
         coalesce(t.items, 0) AS total_items,
         coalesce(t.spend / nullif(t.visits, 0), CAST(0 AS DOUBLE)) AS avg_basket_value,
         coalesce(CAST(t.promo_lines AS DOUBLE) / t.lines, CAST(0 AS DOUBLE)) AS promo_ratio,
         CASE c.customer_taxonomies WHEN 'High Value' THEN 3 WHEN 'Frequent Shopper' THEN 2
              WHEN 'Price Sensitive' THEN 1 WHEN 'Occasional' THEN 0 ELSE -1 END
           AS customer_segment_code
  FROM cust c LEFT JOIN totals t ON t.customer_id = c.customer_id)"""


def percent(salt: str, key: str) -> str:
    return (
        f"CAST('0x' || substr(md5('{salt}:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % 100"
    )


DISPATCH = f"""
disp AS (
  SELECT 'CAMP_01' AS campaign_id, customer_id, 'PROM_001' AS promotion_id,
         CASE WHEN {percent('CAMP_01', 'customer_id')} < 80 THEN 1 ELSE 0 END AS is_treatment
  FROM cust)"""

CAMPAIGN = f"""{DISPATCH},
camp AS (
  SELECT d.*, CASE WHEN EXISTS (
           SELECT 1 FROM orders WHERE o_custkey = d.customer_id
             AND o_orderdate >= {REF} AND o_orderdate < {REF} + INTERVAL 90 DAY)
         THEN 1 ELSE 0 END AS bought_after_promo
  FROM disp d)"""

BAND = """CASE WHEN recency_days <= 30 THEN 0 WHEN recency_days <= 90 THEN 1
          WHEN recency_days <= 180 THEN 2 ELSE 3 END"""

FOLD = f"CASE WHEN {percent('CAMP_01:fold', 'customer_id')} < 30 THEN 'test' ELSE 'train' END"


def scored(train: str = "TRUE") -> str:
    return f"""
people AS (
  SELECT f.*, {BAND} AS band, {FOLD} AS fold, k.is_treatment, k.bought_after_promo
  FROM feat f LEFT JOIN camp k USING (customer_id)),
rates AS (
  SELECT customer_segment_code AS code, band, is_treatment AS arm,
         CAST(sum(bought_after_promo) + 1 AS DOUBLE) / (count(*) + 2) AS rate
  FROM people WHERE is_treatment IS NOT NULL AND {train} GROUP BY ALL),
probs AS (
  SELECT p.*, coalesce(t.rate, CAST(0.5 AS DOUBLE)) AS p_treatment,
         coalesce(c.rate, CAST(0.5 AS DOUBLE)) AS p_control
  FROM people p
  LEFT JOIN rates t ON t.code = p.customer_segment_code AND t.band = p.band AND t.arm = 1
  LEFT JOIN rates c ON c.code = p.customer_segment_code AND c.band = p.band AND c.arm = 0),
scored AS (SELECT *, p_treatment - p_control AS uplift FROM probs)"""


VALUED = """
terms AS (
  SELECT promotion_id, price, cogs, discount AS rate, cogs / price AS cogs_rate,
         CAST(0.5 AS DOUBLE) AS cost
  FROM promo JOIN prod USING (product_id)),
valued AS (
  SELECT s.*, t.promotion_id,
         uplift * price - price * rate * p_treatment AS eir,
         uplift * (price - price * cogs_rate) - price * rate * p_treatment - cost AS eip
  FROM scored s CROSS JOIN terms t)"""

ROWS = """
rounded AS (
  SELECT customer_id, promotion_id, customer_taxonomies, recency_days, total_spend,
         round_even(p_treatment, 4) + 0.0 AS p_buy_treatment,
         round_even(p_control, 4) + 0.0 AS p_buy_control,
         round_even(uplift, 4) + 0.0 AS uplift_score,
         round_even(eir, 2) + 0.0 AS expected_incremental_revenue,
         round_even(eip, 2) + 0.0 AS expected_incremental_profit
  FROM valued WHERE promotion_id = 'PROM_001'),
list AS (
  SELECT *, CASE WHEN uplift_score >= 0.05 THEN 'Persuadal'
                 WHEN uplift_score <= -0.05 THEN 'Sleeping Dog'
                 WHEN p_buy_control >= 0.5 THEN 'Sure Thing' ELSE 'Lost Cause' END
              AS uplift_segment,
         CASE WHEN uplift_score < 0 THEN 'SLEEPING DOG (DO NOT DISTURB)'
              WHEN expected_incremental_profit > 0 THEN 'TARGET' ELSE 'SKIP' END
              AS recommended_action
  FROM rounded)"""

# What-if money from the rounded columns, for the scenarios in a table ``grid``.
WHATIF = """
whatif AS (
  SELECT l.* EXCLUDE (expected_incremental_revenue, expected_incremental_profit,
                      recommended_action),
         g.*,
         uplift_score * g.price - g.price * g.discount_rate * p_buy_treatment AS eir,
         uplift_score * (g.price - g.cogs) - g.price * g.discount_rate * p_buy_treatment
           - g.campaign_cost AS eip,
         g.campaign_cost + g.price * g.discount_rate * p_buy_treatment AS spend
  FROM list l CROSS JOIN grid g),
acted AS (
  SELECT *, CASE WHEN uplift_score < 0 THEN 'SLEEPING DOG (DO NOT DISTURB)'
                 WHEN eip > 0 THEN 'TARGET' ELSE 'SKIP' END AS recommended_action
  FROM whatif)"""


def grid(number: str = "0", factor: str = "1.0", rate: str | None = None) -> str:
    rate = rate or "rate"
    return f"""
grid AS (
  SELECT CAST({number} AS INTEGER) AS scenario_id, price * CAST({factor} AS DOUBLE) AS price,
         CAST({rate} AS DOUBLE) AS discount_rate, cogs, cost AS campaign_cost
  FROM terms WHERE promotion_id = 'PROM_001')"""


FULL_GRID = """
grid AS (
  SELECT CAST(3 * f.i + r.i AS INTEGER) AS scenario_id,
         round_even(price * CAST(f.x AS DOUBLE) * 100, 0) / 100 AS price,
         CAST(r.x AS DOUBLE) AS discount_rate, cogs, cost AS campaign_cost
  FROM terms, (VALUES (0, 0.9), (1, 1.0), (2, 1.1)) f(i, x),
       (VALUES (0, 0.05), (1, 0.10), (2, 0.20)) r(i, x)
  WHERE promotion_id = 'PROM_001')"""

MONEY = "CAST(coalesce(sum(CAST({0} AS DECIMAL(18,8))) {1}, 0) AS DOUBLE)"
TARGETED = "FILTER (WHERE recommended_action = 'TARGET')"
KPIS = f"""
sums AS (
  SELECT scenario_id, price, discount_rate, cogs, campaign_cost, count(*) AS n_customers,
         count(*) {TARGETED} AS n_target,
         count(*) FILTER (WHERE recommended_action LIKE 'SLEEPING%') AS n_sleeping,
         count(*) FILTER (WHERE recommended_action = 'SKIP') AS n_skip,
         {MONEY.format('eir', '')} AS uniform_revenue,
         {MONEY.format('eip', '')} AS uniform_profit,
         {MONEY.format('spend', '')} AS uniform_spend,
         {MONEY.format('eir', TARGETED)} AS optimized_revenue,
         {MONEY.format('eip', TARGETED)} AS optimized_profit,
         {MONEY.format('spend', TARGETED)} AS optimized_spend
  FROM acted GROUP BY ALL)
SELECT *, n_sleeping + n_skip AS n_not_targeted,
       optimized_profit - uniform_profit AS profit_lift,
       coalesce((optimized_profit / nullif(uniform_profit, 0) - 1) * 100, 0) AS profit_lift_pct,
       CASE WHEN uniform_spend > 0 THEN (1 - optimized_spend / uniform_spend) * 100
            ELSE 0 END AS waste_saved_pct,
       uniform_spend - optimized_spend AS spend_saved
FROM sums"""

FEATURES = f"{TRANSACTIONS},{CUSTOMERS},{features()}"
PEOPLE = f"{FEATURES},{CAMPAIGN}"
SCORED = f"{PEOPLE},{scored()}"
LIST = f"{SCORED},{PRODUCTS},{PROMOTIONS},{VALUED},{ROWS}"
SCENARIO = f"{LIST},{grid()},{WHATIF}"


def _pivot(join: str, label: str, values: list[str]) -> str:
    cells = ",\n".join(
        f"CAST(coalesce(sum(h.revenue) FILTER (WHERE d.{label} = '{v}'), 0) AS DOUBLE)"
        f' AS "spend_{v}"'
        for v in values
    )
    return f"""
SELECT c.customer_id, {cells},
       CAST(coalesce(sum(h.revenue), 0) AS DOUBLE) AS spend_total
FROM cust c LEFT JOIN hist h ON h.customer_id = c.customer_id {join}
GROUP BY c.customer_id"""


def _label(join: str, wanted: str) -> str:
    return f"""
SELECT d.*, CASE WHEN EXISTS (
         SELECT 1 FROM tx JOIN prod USING (product_id) {join}
         WHERE {wanted} AND tx.customer_id = d.customer_id
           AND o.promotion_id = d.promotion_id
           AND tx.datetime >= CAST(o.start_date AS TIMESTAMP)
           AND tx.datetime < CAST(o.start_date AS TIMESTAMP) + INTERVAL 90 DAY)
       THEN 1 ELSE 0 END AS bought_after_promo
FROM disp d"""


EARLIER = "TIMESTAMP '2000-07-01'"


def both_dates() -> str:
    """Features as of the starts of two campaigns, as ``dated``."""
    earlier = re.sub(r"\b(hist|totals|feat)\b", r"\1_0", features(EARLIER))
    return f"""{features()},{earlier},
dated AS (
  SELECT *, CAST({EARLIER} AS DATE) AS reference_date FROM feat_0
  UNION ALL SELECT *, CAST({REF} AS DATE) FROM feat)"""


SHIPMENTS = TRANSACTIONS.replace("o_orderdate AS datetime", "l_shipdate AS datetime")

LOGS = f"""
logs AS (
  SELECT 'CAMP_00' AS campaign_id, customer_id, 'PROM_002' AS promotion_id,
         CASE WHEN {percent('CAMP_00', 'customer_id')} < 80 THEN 1 ELSE 0 END AS is_treatment,
         CAST({EARLIER} AS DATE) AS reference_date
  FROM cust
  UNION ALL
  SELECT 'CAMP_01', customer_id, 'PROM_001',
         CASE WHEN {percent('CAMP_01', 'customer_id')} < 80 THEN 1 ELSE 0 END,
         CAST({REF} AS DATE)
  FROM cust),
labelled AS (
  SELECT l.*, CASE WHEN EXISTS (
           SELECT 1 FROM orders WHERE o_custkey = l.customer_id
             AND o_orderdate >= l.reference_date
             AND o_orderdate < l.reference_date + INTERVAL 90 DAY)
         THEN 1 ELSE 0 END AS bought_after_promo
  FROM logs l)"""

CROSSFIT = f"""
pilot AS (
  SELECT f.*, {BAND} AS band, k.is_treatment, k.bought_after_promo,
         CAST({percent('CAMP_01:crossfit', 'customer_id').replace('% 100', '% 5')} AS INTEGER)
           AS fold
  FROM feat f JOIN camp k USING (customer_id)),
rates AS (
  SELECT customer_segment_code AS code, band, is_treatment AS arm, g.f,
         CAST(coalesce(sum(bought_after_promo) FILTER (WHERE fold <> g.f), 0) + 1 AS DOUBLE)
           / (count(*) FILTER (WHERE fold <> g.f) + 2) AS rate
  FROM pilot, (SELECT range AS f FROM range(5)) g GROUP BY ALL),
probs AS (
  SELECT p.*, coalesce(t.rate, CAST(0.5 AS DOUBLE)) AS p_treatment,
         coalesce(c.rate, CAST(0.5 AS DOUBLE)) AS p_control
  FROM pilot p
  LEFT JOIN rates t ON t.code = p.customer_segment_code AND t.band = p.band AND t.arm = 1
    AND t.f = p.fold
  LEFT JOIN rates c ON c.code = p.customer_segment_code AND c.band = p.band AND c.arm = 0
    AND c.f = p.fold),
scored AS (SELECT *, p_treatment - p_control AS uplift FROM probs)"""

NEAREST = """
pts AS (
  SELECT *, CAST(round_even(recency_days * CAST(0.1 AS DOUBLE), 0) AS BIGINT) AS x0,
         CAST(round_even(frequency_30d * CAST(3 AS DOUBLE), 0) AS BIGINT) AS x1,
         CAST(round_even(monetary_90d * CAST(0.00005 AS DOUBLE), 0) AS BIGINT) AS x2
  FROM feat JOIN camp USING (customer_id)),
near AS (
  SELECT t.customer_id, c.customer_id AS control_id, c.bought_after_promo AS control_bought,
         (t.x0 - c.x0) * (t.x0 - c.x0) + (t.x1 - c.x1) * (t.x1 - c.x1)
           + (t.x2 - c.x2) * (t.x2 - c.x2) AS square
  FROM pts t JOIN pts c ON t.customer_segment_code = c.customer_segment_code
    AND t.is_treatment = 1 AND c.is_treatment = 0),
best AS (
  SELECT * FROM near WHERE square <= 16
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY square, control_id) = 1),
matches AS (
  SELECT t.customer_id, b.control_id, b.square, t.bought_after_promo AS bought, b.control_bought
  FROM pts t LEFT JOIN best b USING (customer_id) WHERE t.is_treatment = 1)"""


def poisson(replicates: int) -> str:
    """``drawn``: (customer_id, r, w), a count per customer and replicate, and ``own`` for r = -1
    with all counts 1."""
    steps, total = [], 0.0
    for k in range(12):
        total += math.exp(-1) / math.factorial(k)
        steps.append(math.floor(2**32 * total))
    count = " + ".join(f"(u >= {s})::BIGINT" for s in steps)
    return f"""
drawn AS (
  SELECT customer_id, r, {count} AS w FROM (
    SELECT customer_id, r, CAST('0x' || substr(sha256('CAMP_01:' || CAST(r // 8 AS VARCHAR) || ':'
             || CAST(customer_id AS VARCHAR)), 8 * (r % 8) + 1, 8) AS BIGINT) AS u
    FROM cust, (SELECT range AS r FROM range({replicates}))) z
  UNION ALL SELECT customer_id, -1, 1 FROM cust)"""


def intervals(group: str, values: dict[str, str]) -> str:
    """One row per group from ``sums`` (group, r, n_t, y_t, n_c, y_c)."""
    lists = ", ".join(
        f"list_sort(list({v}) FILTER (WHERE r >= 0 AND {v} IS NOT NULL)) AS {v}_l,"
        f" any_value({v}) FILTER (WHERE r = -1) AS {v}"
        for v in values
    )
    exprs = ", ".join(f"{e} AS {v}" for v, e in values.items())
    cut = "CAST(floor(len({0}_l) * CAST(0.025 AS DOUBLE)) AS BIGINT)"
    told = ", ".join(
        f"{v}, {v}_l[{cut.format(v)} + 1] AS {v}_low, {v}_l[len({v}_l) - {cut.format(v)}] AS {v}_high"
        for v in values
    )
    return f"""
each AS (SELECT *, {exprs} FROM sums),
listed AS (
  SELECT {group}, {lists},
         any_value(n_t) FILTER (WHERE r = -1) AS n_treated,
         any_value(y_t) FILTER (WHERE r = -1) AS buyers_treated,
         any_value(n_c) FILTER (WHERE r = -1) AS n_control,
         any_value(y_c) FILTER (WHERE r = -1) AS buyers_control
  FROM each GROUP BY {group})
SELECT {group}, n_treated, buyers_treated, n_control, buyers_control, {told} FROM listed"""


SUMS = """CAST(sum(w * is_treatment) AS BIGINT) AS n_t,
         CAST(sum(w * is_treatment * bought_after_promo) AS BIGINT) AS y_t,
         CAST(sum(w * (1 - is_treatment)) AS BIGINT) AS n_c,
         CAST(sum(w * (1 - is_treatment) * bought_after_promo) AS BIGINT) AS y_c"""
RATE_T = "CAST(y_t AS DOUBLE) / nullif(n_t, 0)"
RATE_C = "CAST(y_c AS DOUBLE) / nullif(n_c, 0)"

QUARTER = VALUED.replace("discount AS rate", "discount * CAST(0.25 AS DOUBLE) AS rate").replace(
    "CAST(0.5 AS DOUBLE) AS cost", "CAST(0.125 AS DOUBLE) AS cost"
)

# All choices at every price at which some customer's could change, instead of a search.
BUDGET = """
opts AS (
  SELECT customer_id, promotion_id, CAST(round_even(eip * 100, 0) AS BIGINT) AS p,
         CAST(round_even((cost + price * rate * p_treatment) * 100, 0) AS BIGINT) AS s
  FROM (SELECT v.*, t.price, t.rate, t.cost FROM valued v JOIN terms t USING (promotion_id))),
good AS (
  SELECT * FROM opts WHERE p > 0
  UNION ALL SELECT customer_id, NULL, 0, 0 FROM (SELECT DISTINCT customer_id FROM opts)),
prices AS (
  SELECT DISTINCT unnest([m, m + 1]) AS m FROM (
    SELECT DISTINCT (a.p - b.p) * 1048576 // (a.s - b.s) AS m
    FROM good a JOIN good b ON a.customer_id = b.customer_id AND a.s > b.s AND a.p > b.p)
  UNION SELECT 0),
wide AS (SELECT DISTINCT unnest([m - 1, m]) AS m FROM prices),
kinds AS (SELECT customer_id, list((p, s, promotion_id) ORDER BY promotion_id) AS k
          FROM good GROUP BY 1),
sizes AS (SELECT k, count(*) AS n FROM kinds GROUP BY 1),
taken AS (
  SELECT k, m, list_sort(list_transform(k, lambda o: struct_pack(
             w := -(o[1] * 1048576 - o[2] * m), c := o[2], i := coalesce(o[3], ''), p := o[1])))[1]
           AS o
  FROM sizes, wide WHERE m >= 0),
spends AS (SELECT m, sum(n * o.c) AS spent FROM taken JOIN sizes USING (k) GROUP BY m),
budget AS (SELECT spent * 30 // 100 AS b FROM spends WHERE m = 0),
found AS (
  SELECT min(m) AS m FROM spends, budget WHERE spent <= b AND m IN (SELECT m FROM prices)),
picked AS (
  SELECT customer_id, o.i AS promotion_id, o.p AS profit, o.c AS spend
  FROM kinds JOIN taken USING (k) JOIN found USING (m)),
dearer AS (
  SELECT customer_id, o.i AS promotion_id, o.p AS profit, o.c AS spend
  FROM kinds JOIN taken USING (k) JOIN found ON taken.m = found.m - 1),
margin AS (
  SELECT d.*, sum(d.spend - p.spend) OVER (ORDER BY customer_id) AS upto
  FROM dearer d JOIN picked p USING (customer_id) WHERE d.spend > p.spend),
upgraded AS (
  SELECT * FROM margin
  WHERE upto <= (SELECT b FROM budget) - (SELECT sum(spend) FROM picked)),
allocated AS (
  SELECT customer_id, coalesce(u.promotion_id, p.promotion_id) AS promotion_id,
         coalesce(u.profit, p.profit) AS profit, coalesce(u.spend, p.spend) AS spend
  FROM picked p LEFT JOIN upgraded u USING (customer_id)
  WHERE coalesce(u.promotion_id, p.promotion_id) <> '')"""

QINI = """
ranked AS (
  SELECT customer_id, CAST(bought_after_promo AS BIGINT) AS y,
         CAST(is_treatment AS BIGINT) AS w, uplift AS score,
         row_number() OVER o AS n_pop,
         CAST(sum(is_treatment) OVER o AS BIGINT) AS n_t,
         CAST(sum(bought_after_promo * is_treatment) OVER o AS BIGINT) AS y_t,
         CAST(sum(bought_after_promo * (1 - is_treatment)) OVER o AS BIGINT) AS y_c
  FROM scored WHERE is_treatment IS NOT NULL AND {which}
  WINDOW o AS (ORDER BY uplift DESC, customer_id ROWS UNBOUNDED PRECEDING)),
ends AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(w) AS DOUBLE) AS t,
         CAST(sum(y * w) AS DOUBLE) AS yt, CAST(sum(y * (1 - w)) AS DOUBLE) AS yc
  FROM ranked)
SELECT customer_id, y, w, score, n_pop, n_t, n_pop - n_t AS n_c, y_t, y_c,
       coalesce(y_t - y_c * (CAST(n_t AS DOUBLE) / nullif(n_pop - n_t, 0)), y_t) AS qini,
       n_pop / n * (yt - yc * (t / nullif(n - t, 0))) AS random
FROM ranked, ends"""

QUARTILES = """
tiles AS (
  SELECT *, CAST(ntile(4) OVER (ORDER BY recency_days, customer_id) AS INTEGER) AS r_quartile,
         CAST(ntile(4) OVER (ORDER BY frequency_30d DESC, customer_id) AS INTEGER) AS f_quartile,
         CAST(ntile(4) OVER (ORDER BY monetary_90d DESC, customer_id) AS INTEGER) AS m_quartile
  FROM feat LEFT JOIN camp USING (customer_id)),
quart AS (
  SELECT *, r_quartile + f_quartile + m_quartile AS rfm_score,
         CAST(ntile(4) OVER (ORDER BY r_quartile + f_quartile + m_quartile, customer_id)
              AS INTEGER) AS rfm_quartile
  FROM tiles)"""

RANKED_LIST = """
ranked AS (
  SELECT *, row_number() OVER (ORDER BY uplift_score DESC, customer_id) AS n_pop,
         count(*) OVER () AS n_all
  FROM list)"""

REPORT = """
marked AS (
  SELECT policy, expected_incremental_revenue AS eir, expected_incremental_profit AS eip,
         0.5 + p_buy_treatment * (SELECT price * rate FROM terms
                                  WHERE promotion_id = 'PROM_001') AS spend
  FROM chosen),
sums AS (
  SELECT p.policy, count(spend) AS n_targeted,
         CAST(coalesce(sum(CAST(eir AS DECIMAL(18,4))), 0) AS DOUBLE) AS revenue,
         CAST(coalesce(sum(CAST(eip AS DECIMAL(18,4))), 0) AS DOUBLE) AS profit,
         CAST(coalesce(sum(CAST(spend AS DECIMAL(18,8))), 0) AS DOUBLE) AS spend
  FROM (VALUES {policies}) p(policy) LEFT JOIN marked m ON m.policy = p.policy
  GROUP BY p.policy),
base AS (SELECT revenue AS r, spend AS s FROM sums WHERE policy = '{base}')
SELECT policy, n_targeted, revenue, profit, spend,
       CASE WHEN r > 0 THEN (revenue / r - 1) * 100 END AS revenue_uplift_pct,
       (1 - spend / nullif(s, 0)) * 100 AS spend_saved_pct
FROM sums, base"""

TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
FEATURE_COLUMNS = [
    "recency_days",
    "frequency_30d",
    "monetary_90d",
    "total_spend",
    "total_visits",
    "total_items",
    "avg_basket_value",
    "promo_ratio",
    "customer_segment_code",
]


def _profile(column: str) -> str:
    x = f"CAST({column} AS DOUBLE)"
    return f"""
SELECT '{column}' AS feature, count({x}) AS n, round_even(avg({x}), 4) + 0.0 AS mean,
       round_even(stddev_samp({x}), 4) + 0.0 AS std, min({x}) AS min,
       round_even(quantile_cont({x}, 0.25), 4) + 0.0 AS q25,
       round_even(quantile_cont({x}, 0.5), 4) + 0.0 AS q50,
       round_even(quantile_cont({x}, 0.75), 4) + 0.0 AS q75, max({x}) AS max
FROM feat"""


def _share_row(share: str) -> str:
    return f"""
SELECT CAST({share} AS DOUBLE) AS share, CAST(max(floor({share} * n_all)) AS BIGINT) AS n_top,
       count(*) FILTER (WHERE top AND is_treatment = 1) AS n_treated,
       count(*) FILTER (WHERE top AND is_treatment = 1 AND bought_after_promo = 1)
         AS buyers_treated,
       count(*) FILTER (WHERE top AND is_treatment = 0) AS n_control,
       count(*) FILTER (WHERE top AND is_treatment = 0 AND bought_after_promo = 1)
         AS buyers_control
FROM (SELECT *, n_pop <= floor({share} * n_all) AS top FROM ranked)"""


def _scan(name: str, key: str, table: str) -> str:
    return f"""
SELECT '{name}' AS table_name, count(*) AS n_rows, CAST(min({key}) AS VARCHAR) AS min_key,
       CAST(max({key}) AS VARCHAR) AS max_key FROM {table}"""


APPENDED = """SELECT datetime, product_id, price, qty, customer_id, promotion_id, store_id,
       CAST(po_id AS VARCHAR) AS po_id FROM tx
UNION ALL
SELECT CAST(start_date AS TIMESTAMP) + INTERVAL 62 HOUR, product_id,
       CASE WHEN is_treatment = 1 THEN round_even(price - price * discount, 2) ELSE price END,
       1, customer_id, CASE WHEN is_treatment = 1 THEN promotion_id ELSE '' END, 2,
       'PO_CAMP_01_' || CAST(customer_id AS VARCHAR)
FROM camp JOIN promo USING (promotion_id) JOIN prod USING (product_id)
WHERE bought_after_promo = 1"""

OTHER_DISCOUNT = f"{LIST},{grid('1', '1.0', '0.17')},{WHATIF}"
EXACT = "CAST(sum(CAST({0} AS DECIMAL(18,8))) AS DOUBLE)"
EVERY_ROW = """
SELECT c_custkey AS customer_id, TRUE AS probabilities, TRUE AS difference, TRUE AS money,
       TRUE AS quadrant, TRUE AS action
FROM customer"""

SQL: dict[str, str] = {
    "scan_tables": f"WITH {FEATURES},{PRODUCTS},{STORES},{PROMOTIONS},{DISPATCH}"
    + " UNION ALL ".join(
        _scan(*x)
        for x in (
            ("customers", "customer_id", "cust"),
            ("products", "product_id", "prod"),
            ("stores", "store_id", "store"),
            ("promotions", "promotion_id", "promo"),
            ("transactions", "po_id", "tx"),
            ("campaign", "customer_id", "disp"),
        )
    ),
    "rfm_features": f"WITH {FEATURES} SELECT * FROM feat",
    "rfm_features_lines": f"WITH {FEATURES} SELECT * FROM feat",
    "rfm_features_subday": (
        f"WITH {SUBDAY},{CUSTOMERS},{features(SUBDAY_REF)}"
        " SELECT * FROM feat"
    ),
    "star_join": f"""WITH {TRANSACTIONS},{CUSTOMERS},{PRODUCTS},{STORES},{PROMOTIONS},{CAMPAIGN},
facts AS ({APPENDED})
SELECT tx.*, customer_taxonomies, discount, start_date, end_date, product_taxonomies,
       prod.price AS product_price, store_taxonomies
FROM facts tx LEFT JOIN cust USING (customer_id) LEFT JOIN promo p ON p.promotion_id = tx.promotion_id
LEFT JOIN prod ON prod.product_id = tx.product_id LEFT JOIN store USING (store_id)""",
    "discount_depth": f"""WITH {TRANSACTIONS},{PRODUCTS}
SELECT po_id, product_id, promotion_id, tx.price AS paid_price, prod.price AS list_price,
       1 - tx.price / nullif(prod.price, 0) AS discount_depth
FROM tx LEFT JOIN prod USING (product_id)""",
    "category_pivot": f"WITH {FEATURES},{PRODUCTS}"
    + _pivot("LEFT JOIN prod d ON d.product_id = h.product_id", "product_taxonomies", TYPES),
    "store_pivot": f"WITH {FEATURES},{STORES}"
    + _pivot(
        "LEFT JOIN store d ON d.store_id = h.store_id",
        "store_taxonomies",
        [f"NATION_{i}" for i in range(25)],
    ),
    "feature_profile": f"WITH {FEATURES}" + " UNION ALL ".join(map(_profile, FEATURE_COLUMNS)),
    "feature_head": f"WITH {FEATURES} SELECT * FROM feat ORDER BY customer_id LIMIT 5",
    "holdout_assign": f"""WITH {CUSTOMERS},{DISPATCH}
SELECT customer_id, is_treatment, {FOLD} AS fold FROM disp""",
    "response_label": f"WITH {TRANSACTIONS},{CUSTOMERS},{PRODUCTS},{PROMOTIONS},{DISPATCH}"
    + _label(
        "JOIN prod q ON q.product_taxonomies = prod.product_taxonomies"
        " JOIN promo o ON o.product_id = q.product_id",
        "TRUE",
    ),
    "response_label_product": (
        f"WITH {TRANSACTIONS},{CUSTOMERS},{PRODUCTS},{PROMOTIONS},{DISPATCH}"
        + _label("JOIN promo o ON o.product_id = tx.product_id", "TRUE")
    ),
    "response_label_7d": f"""WITH {CUSTOMERS},{DISPATCH}
SELECT d.*, CASE WHEN EXISTS (
         SELECT 1 FROM events WHERE event_type = 'purchase' AND user_id = d.customer_id
           AND ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-22')
       THEN 1 ELSE 0 END AS bought_after_promo
FROM disp d""",
    "arms_from_fact": f"""WITH {TRANSACTIONS},{CUSTOMERS}
SELECT customer_id, CASE WHEN customer_id IN (
         SELECT customer_id FROM tx WHERE promotion_id = 'PROM_HIST'
           AND datetime >= {REF} AND datetime < {REF} + INTERVAL 90 DAY)
       THEN 1 ELSE 0 END AS is_treatment
FROM cust""",
    "training_set": f"WITH {PEOPLE} SELECT * FROM camp JOIN feat USING (customer_id)",
    "arm_summary": f"""WITH {CUSTOMERS},{CAMPAIGN},
n AS (
  SELECT count(*) FILTER (WHERE is_treatment = 1) AS n_treated,
         count(*) FILTER (WHERE is_treatment = 1 AND bought_after_promo = 1) AS buyers_treated,
         count(*) FILTER (WHERE is_treatment = 0) AS n_control,
         count(*) FILTER (WHERE is_treatment = 0 AND bought_after_promo = 1) AS buyers_control
  FROM camp),
r AS (
  SELECT *, CAST(buyers_treated AS DOUBLE) / nullif(n_treated, 0) AS rate_treated,
         CAST(buyers_control AS DOUBLE) / nullif(n_control, 0) AS rate_control FROM n)
SELECT *, rate_treated - rate_control AS average_effect FROM r""",
    "matched_controls": f"""WITH {PEOPLE},
bins AS (
  SELECT customer_segment_code, {BAND} AS band, least(frequency_30d, 2) AS freq,
         CAST(sum(is_treatment) AS BIGINT) AS nt, CAST(sum(1 - is_treatment) AS BIGINT) AS nc,
         sum(is_treatment * bought_after_promo) AS bt,
         sum((1 - is_treatment) * bought_after_promo) AS bc
  FROM camp JOIN feat USING (customer_id) GROUP BY ALL)
SELECT count(*) FILTER (WHERE nt > 0 AND nc > 0) AS n_bins,
       CAST(coalesce(sum(nt) FILTER (WHERE nc > 0), 0) AS BIGINT) AS n_treated_matched,
       CAST(coalesce(sum(nt) FILTER (WHERE nc = 0), 0) AS BIGINT) AS n_treated_unmatched,
       round_even(sum(nt * (CAST(bt AS DOUBLE) / nullif(nt, 0) - CAST(bc AS DOUBLE) / nullif(nc, 0)))
                    FILTER (WHERE nt > 0 AND nc > 0)
                  / nullif(sum(nt) FILTER (WHERE nc > 0), 0), 8) + 0.0 AS matched_effect
FROM bins""",
    "append_campaign": f"""WITH {TRANSACTIONS},{CUSTOMERS},{PRODUCTS},{PROMOTIONS},{CAMPAIGN}
{APPENDED}""",
    "tlearner_stratified": (
        f"WITH {SCORED} SELECT customer_id, p_treatment, p_control, uplift FROM scored"
    ),
    "value_scores": f"""WITH {SCORED},{PRODUCTS},{PROMOTIONS},{VALUED}
SELECT customer_id, p_treatment, p_control, uplift, promotion_id, eir, eip FROM valued""",
    "targeting_list": f"""WITH {LIST} SELECT * FROM list
ORDER BY expected_incremental_profit DESC, customer_id""",
    "top100": f"""WITH {LIST}
SELECT customer_id, customer_taxonomies, uplift_score, expected_incremental_profit,
       recommended_action
FROM list ORDER BY expected_incremental_profit DESC, customer_id LIMIT 100""",
    "action_counts": f"""WITH {LIST}
SELECT recommended_action, count(*) AS n_customers FROM list GROUP BY 1""",
    "quadrant_counts": f"""WITH {LIST}
SELECT uplift_segment, count(*) AS n_customers FROM list GROUP BY 1""",
    "segment_means": f"""WITH {LIST}
SELECT customer_taxonomies, count(*) AS n_customers,
       CAST(sum(CAST(uplift_score AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS mean_uplift,
       CAST(sum(CAST(expected_incremental_profit AS DECIMAL(18,4))) AS DOUBLE) / count(*)
         AS mean_profit
FROM list GROUP BY 1""",
    "segment_profit": f"""WITH {LIST}
SELECT customer_taxonomies,
       CAST(sum(CAST(expected_incremental_profit AS DECIMAL(18,4))) AS DOUBLE) AS total_profit
FROM list GROUP BY 1""",
    "campaign_kpis": f"WITH {SCENARIO},{KPIS}",
    "whatif_list": f"""WITH {LIST},{grid("1", "1.0", "0.10")},{WHATIF}
SELECT * EXCLUDE (scenario_id, price, discount_rate, cogs, campaign_cost, spend, eir, eip),
       eir AS expected_incremental_revenue, eip AS expected_incremental_profit
FROM acted""",
    "whatif_top100": f"""WITH {OTHER_DISCOUNT}
SELECT customer_id, customer_taxonomies, uplift_score, eip AS expected_incremental_profit,
       recommended_action
FROM acted ORDER BY eip DESC, customer_id LIMIT 100""",
    "whatif_action_counts": f"""WITH {OTHER_DISCOUNT}
SELECT recommended_action, count(*) AS n_customers FROM acted GROUP BY 1""",
    "whatif_segment_means": f"""WITH {OTHER_DISCOUNT}
SELECT customer_taxonomies, count(*) AS n_customers,
       {EXACT.format('uplift_score')} / count(*) AS mean_uplift,
       {EXACT.format('eip')} / count(*) AS mean_profit
FROM acted GROUP BY 1""",
    "whatif_segment_profit": f"""WITH {OTHER_DISCOUNT}
SELECT customer_taxonomies, {EXACT.format('eip')} AS total_profit FROM acted GROUP BY 1""",
    "whatif_policies": f"""WITH {OTHER_DISCOUNT},
chosen AS (
  SELECT 'uniform' AS policy, * FROM acted
  UNION ALL SELECT 'targets', * FROM acted WHERE recommended_action = 'TARGET'),
sums AS (
  SELECT p.policy, count(spend) AS n_targeted,
         coalesce({EXACT.format('eir')}, 0) AS revenue,
         coalesce({EXACT.format('eip')}, 0) AS profit,
         coalesce({EXACT.format('spend')}, 0) AS spend
  FROM (VALUES ('uniform'), ('targets')) p(policy) LEFT JOIN chosen m ON m.policy = p.policy
  GROUP BY p.policy),
base AS (SELECT revenue AS r, spend AS s FROM sums WHERE policy = 'uniform')
SELECT policy, n_targeted, revenue, profit, spend,
       CASE WHEN r > 0 THEN (revenue / r - 1) * 100 END AS revenue_uplift_pct,
       (1 - spend / nullif(s, 0)) * 100 AS spend_saved_pct
FROM sums, base""",
    "targeting_list_all": "WITH "
    + LIST.replace("FROM valued WHERE promotion_id = 'PROM_001'", "FROM valued")
    + " SELECT * FROM list",
    "gbt_invariants": EVERY_ROW,
    "forest_invariants": EVERY_ROW,
    "whatif_grid": f"WITH {LIST},{FULL_GRID},{WHATIF},{KPIS}",
    "profit_curve": f"""WITH {SCENARIO}
SELECT customer_id, eir AS expected_incremental_revenue, eip AS expected_incremental_profit,
       row_number() OVER o AS n_pop,
       CAST(sum(CAST(eir AS DECIMAL(18,8))) OVER o AS DOUBLE) AS cum_revenue,
       CAST(sum(CAST(eip AS DECIMAL(18,8))) OVER o AS DOUBLE) AS cum_profit,
       CAST(row_number() OVER o AS DOUBLE) / count(*) OVER () * 100 AS pct_population
FROM acted WINDOW o AS (ORDER BY eip DESC, customer_id ROWS UNBOUNDED PRECEDING)""",
    "best_cutoff": f"""WITH {SCENARIO},
curve AS (
  SELECT row_number() OVER o AS n_pop, count(*) OVER () AS n,
         CAST(sum(CAST(eip AS DECIMAL(18,8))) OVER o AS DOUBLE) AS cum_profit
  FROM acted WINDOW o AS (ORDER BY eip DESC, customer_id ROWS UNBOUNDED PRECEDING))
SELECT n_pop, CAST(n_pop AS DOUBLE) / n * 100 AS pct_population, cum_profit AS max_profit
FROM curve ORDER BY cum_profit DESC, n_pop LIMIT 1""",
    "quadrant_confusion": f"""WITH {LIST},
truth AS (
  SELECT customer_id, {percent('TRUTH', 'customer_id')} AS draw FROM cust)
SELECT CASE WHEN draw < 35 THEN 'Persuadal' WHEN draw < 65 THEN 'Sure Thing'
            WHEN draw < 90 THEN 'Lost Cause' ELSE 'Sleeping Dog' END AS true_uplift_segment,
       uplift_segment AS predicted_uplift_segment, count(*) AS n_customers
FROM list JOIN truth USING (customer_id) GROUP BY ALL""",
    "export_targets": f"WITH {LIST} SELECT * FROM list WHERE recommended_action = 'TARGET'",
    "export_saved_targets": f"WITH {LIST} SELECT * FROM list WHERE recommended_action = 'TARGET'",
    "batch_scoring": f"""WITH {LIST}
SELECT * REPLACE (CAST(customer_id AS VARCHAR) AS customer_id) FROM list""",
    "qini_curve": f"WITH {SCORED},{QINI.format(which='TRUE')}",
    "heldout_qini": f"""WITH {PEOPLE},{scored("fold = 'train'")},
{QINI.format(which="fold = 'test'")}""",
    "uplift_at_k": f"""WITH {SCORED},
ranked AS (
  SELECT *, row_number() OVER (ORDER BY uplift DESC, customer_id) AS n_pop,
         count(*) OVER () AS n_all
  FROM scored WHERE is_treatment IS NOT NULL),
k AS ({" UNION ALL ".join(map(_share_row, ("0.1", "0.2", "0.3", "0.5")))})
SELECT *, CAST(buyers_treated AS DOUBLE) / nullif(n_treated, 0)
          - CAST(buyers_control AS DOUBLE) / nullif(n_control, 0) AS uplift_at_k
FROM k""",
    "auc": f"""WITH {SCORED},
own AS (
  SELECT is_treatment, bought_after_promo AS y,
         CASE WHEN is_treatment = 1 THEN p_treatment ELSE p_control END AS score
  FROM scored WHERE is_treatment IS NOT NULL),
mid AS (
  SELECT *, rank() OVER (PARTITION BY is_treatment ORDER BY score)
            + (count(*) OVER (PARTITION BY is_treatment, score) - 1) / 2.0 AS mid_rank
  FROM own),
sums AS (
  SELECT is_treatment, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives,
         sum(CAST(mid_rank AS DECIMAL(18,1))) FILTER (WHERE y = 1) AS rank_sum
  FROM mid GROUP BY 1)
SELECT is_treatment, n, positives,
       CAST(2 * rank_sum - positives * (positives + 1) AS DOUBLE)
         / nullif(2 * CAST(positives AS DOUBLE) * (n - positives), 0) AS auc
FROM sums""",
    "precision_at_20": f"""WITH {SCORED},
own AS (
  SELECT is_treatment, bought_after_promo AS y, customer_id,
         CASE WHEN is_treatment = 1 THEN p_treatment ELSE p_control END AS score
  FROM scored WHERE is_treatment IS NOT NULL),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY is_treatment ORDER BY score DESC, customer_id) AS r,
         count(*) OVER (PARTITION BY is_treatment) AS n FROM own)
SELECT is_treatment, count(*) AS n_top, CAST(sum(y) AS BIGINT) AS buyers,
       CAST(sum(y) AS DOUBLE) / count(*) AS precision
FROM placed WHERE r <= floor(0.2 * n) GROUP BY 1""",
    "rfm_quartiles": f"""WITH {PEOPLE},{QUARTILES}
SELECT customer_id, r_quartile, f_quartile, m_quartile, rfm_score, rfm_quartile FROM quart""",
    "quartile_redemption": f"""WITH {PEOPLE},{QUARTILES}
SELECT rfm_quartile, count(*) AS n, CAST(sum(bought_after_promo) AS BIGINT) AS buyers,
       CAST(sum(bought_after_promo) AS DOUBLE) / count(*) AS redemption_rate
FROM quart WHERE is_treatment = 1 GROUP BY 1""",
    "response_signal": f"""WITH {PEOPLE},{QUARTILES},
n AS (
  SELECT count(*) FILTER (WHERE rfm_quartile = 1) AS n_q1,
         count(*) FILTER (WHERE rfm_quartile = 1 AND bought_after_promo = 1) AS buyers_q1,
         count(*) FILTER (WHERE rfm_quartile = 4) AS n_q4,
         count(*) FILTER (WHERE rfm_quartile = 4 AND bought_after_promo = 1) AS buyers_q4
  FROM quart WHERE is_treatment = 1),
r AS (
  SELECT *, CAST(buyers_q1 AS DOUBLE) / nullif(n_q1, 0) AS rate_q1,
         CAST(buyers_q4 AS DOUBLE) / nullif(n_q4, 0) AS rate_q4,
         CAST(buyers_q1 + buyers_q4 AS DOUBLE) / nullif(n_q1 + n_q4, 0) AS pooled
  FROM n)
SELECT * EXCLUDE (pooled),
       (rate_q1 - rate_q4)
         / nullif(sqrt(pooled * (1 - pooled)
                       * (CAST(1 AS DOUBLE) / n_q1 + CAST(1 AS DOUBLE) / n_q4)), 0) AS z
FROM r""",
    "top30_policy": f"""WITH {LIST},{RANKED_LIST}
SELECT customer_id, customer_taxonomies, uplift_score, n_pop
FROM ranked WHERE n_pop <= floor(0.3 * n_all)""",
    "budget_efficiency": f"""WITH {LIST},{RANKED_LIST},
chosen AS (
  SELECT 'uniform' AS policy, * FROM ranked
  UNION ALL SELECT 'top30', * FROM ranked WHERE n_pop <= floor(0.3 * n_all)),
{REPORT.format(base='uniform', policies="('uniform'), ('top30')")}""",
    "category_buyers": f"""WITH {TRANSACTIONS},{CUSTOMERS},{PRODUCTS}
SELECT * FROM cust WHERE customer_id IN (
  SELECT customer_id FROM tx JOIN prod USING (product_id)
  WHERE product_taxonomies = 'PROMO' AND datetime < {REF})""",
    "policy_baselines": f"""WITH {LIST},{RANKED_LIST},
chosen AS (
  SELECT 'all' AS policy, * FROM ranked
  UNION ALL SELECT 'category_buyers', * FROM ranked WHERE customer_id IN (
    SELECT customer_id FROM tx JOIN prod USING (product_id)
    WHERE product_taxonomies = 'PROMO' AND datetime < {REF})
  UNION ALL SELECT 'top30', * FROM ranked WHERE n_pop <= floor(0.3 * n_all)
  UNION ALL SELECT 'eip_positive', * FROM ranked WHERE recommended_action = 'TARGET'),
{REPORT.format(base='all', policies="('all'), ('category_buyers'), ('top30'), ('eip_positive')")}""",
    "features_as_of": f"WITH {TRANSACTIONS},{CUSTOMERS},{both_dates()} SELECT * FROM dated",
    "features_as_of_lines": f"WITH {SHIPMENTS},{CUSTOMERS},{both_dates()} SELECT * FROM dated",
    "training_set_as_of": f"""WITH {TRANSACTIONS},{CUSTOMERS},{both_dates()},{LOGS}
SELECT l.campaign_id, l.promotion_id, l.is_treatment, l.bought_after_promo, d.*
FROM labelled l JOIN dated d USING (customer_id, reference_date)""",
    "crossfit_scores": f"""WITH {PEOPLE},{CROSSFIT}
SELECT customer_id, fold, p_treatment, p_control, uplift FROM scored""",
    "crossfit_qini": f"WITH {PEOPLE},{CROSSFIT},{QINI.format(which='TRUE')}",
    "model_table_scores": f"""WITH {FEATURES},
votes AS (
  SELECT customer_id,
         1.0::DOUBLE * CASE WHEN recency_days <= 60
             THEN CASE WHEN total_spend <= 500000 THEN 0.125::DOUBLE ELSE 0.5::DOUBLE END
             ELSE -0.625::DOUBLE END
           + 0.25::DOUBLE * CASE WHEN customer_segment_code <= 1.5 THEN -0.3::DOUBLE
             WHEN promo_ratio <= 0.15::DOUBLE THEN 0.2::DOUBLE ELSE 0.7::DOUBLE END AS margin,
         (CASE WHEN frequency_30d <= 0.5 THEN 0.2::DOUBLE ELSE 0.55::DOUBLE END
           + CASE WHEN avg_basket_value <= 100000 THEN 0.1::DOUBLE ELSE 0.35::DOUBLE END
           + 0.3::DOUBLE) / 3 AS p_c
  FROM feat),
exact AS (
  SELECT customer_id, 1 / (1 + exp(-2 * margin)) AS p_t, p_c FROM votes)
SELECT customer_id, round_even(p_t, 9) + 0.0 AS p_treatment, round_even(p_c, 9) + 0.0 AS p_control,
       round_even(p_t - p_c, 9) + 0.0 AS uplift
FROM exact""",
    "model_table_check": f"""WITH {CUSTOMERS}
SELECT customer_id, TRUE AS same_p_treatment, TRUE AS same_p_control, TRUE AS same_uplift
FROM cust""",
    "grouped_ranks": """
WITH lines AS (
  SELECT CASE WHEN l_discount > CAST(0.065 AS DOUBLE) THEN 'discounted'
              ELSE CAST(l_partkey AS VARCHAR) END AS offer,
         l_orderkey * 100 + l_linenumber AS line_id, l_extendedprice AS revenue
  FROM lineitem)
SELECT *, row_number() OVER o AS place,
       CAST(sum(CAST(round_even(revenue * 100, 0) AS BIGINT)) OVER o AS BIGINT) AS running_cents
FROM lines
WINDOW o AS (PARTITION BY offer ORDER BY revenue DESC, line_id ROWS UNBOUNDED PRECEDING)""",
    "qini_curves": f"""WITH {TRANSACTIONS},{CUSTOMERS},{both_dates()},{LOGS},
pilot AS (
  SELECT l.campaign_id, l.is_treatment, l.bought_after_promo, d.*, {BAND} AS band
  FROM labelled l JOIN dated d USING (customer_id, reference_date)),
rates AS (
  SELECT customer_segment_code AS code, band, is_treatment AS arm,
         CAST(sum(bought_after_promo) + 1 AS DOUBLE) / (count(*) + 2) AS rate
  FROM pilot GROUP BY ALL),
scored AS (
  SELECT p.*, coalesce(t.rate, CAST(0.5 AS DOUBLE)) - coalesce(c.rate, CAST(0.5 AS DOUBLE))
           AS uplift
  FROM pilot p
  LEFT JOIN rates t ON t.code = p.customer_segment_code AND t.band = p.band AND t.arm = 1
  LEFT JOIN rates c ON c.code = p.customer_segment_code AND c.band = p.band AND c.arm = 0),
ranked AS (
  SELECT campaign_id, customer_taxonomies, customer_id, CAST(bought_after_promo AS BIGINT) AS y,
         CAST(is_treatment AS BIGINT) AS w, uplift AS score,
         row_number() OVER o AS n_pop,
         CAST(sum(is_treatment) OVER o AS BIGINT) AS n_t,
         CAST(sum(bought_after_promo * is_treatment) OVER o AS BIGINT) AS y_t,
         CAST(sum(bought_after_promo * (1 - is_treatment)) OVER o AS BIGINT) AS y_c
  FROM scored
  WINDOW o AS (PARTITION BY campaign_id, customer_taxonomies
               ORDER BY uplift DESC, customer_id ROWS UNBOUNDED PRECEDING)),
ends AS (
  SELECT campaign_id, customer_taxonomies, CAST(count(*) AS DOUBLE) AS n,
         CAST(sum(w) AS DOUBLE) AS t, CAST(sum(y * w) AS DOUBLE) AS yt,
         CAST(sum(y * (1 - w)) AS DOUBLE) AS yc
  FROM ranked GROUP BY ALL)
SELECT campaign_id, customer_taxonomies, customer_id, y, w, score, n_pop, n_t, n_pop - n_t AS n_c,
       y_t, y_c,
       coalesce(y_t - y_c * (CAST(n_t AS DOUBLE) / nullif(n_pop - n_t, 0)), y_t) AS qini,
       n_pop / n * (yt - yc * (t / nullif(n - t, 0))) AS random
FROM ranked JOIN ends USING (campaign_id, customer_taxonomies)""",
    "nearest_controls": f"WITH {PEOPLE},{NEAREST} SELECT * FROM matches",
    "nearest_effect": f"""WITH {PEOPLE},{NEAREST}
SELECT count(control_id) AS n_matched, count(*) - count(control_id) AS n_unmatched,
       count(DISTINCT control_id) AS n_controls,
       CAST(coalesce(sum(bought) FILTER (WHERE control_id IS NOT NULL), 0) AS BIGINT) AS buyers,
       CAST(coalesce(sum(control_bought), 0) AS BIGINT) AS control_buyers,
       CAST(sum(bought - control_bought) AS DOUBLE) / nullif(count(control_id), 0)
         AS matched_effect
FROM matches""",
    "uplift_intervals": f"""WITH {PEOPLE},{CROSSFIT},{poisson(20)},
placed AS (
  SELECT *, row_number() OVER (ORDER BY uplift DESC, customer_id) AS place, count(*) OVER () AS n
  FROM scored),
sums AS (
  SELECT share, r, {SUMS}
  FROM placed JOIN drawn USING (customer_id),
       (SELECT unnest([0.1, 0.2, 0.3, 0.5]::DOUBLE[]) AS share)
  WHERE place <= floor(CAST(share AS DECIMAL(3, 1)) * n) GROUP BY ALL),
{intervals('share', {
    'uplift': f'{RATE_T} - {RATE_C}',
    'qini': 'coalesce(y_t - y_c * (CAST(n_t AS DOUBLE) / nullif(n_c, 0)), y_t)',
})}""",
    "quartile_intervals": f"""WITH {PEOPLE},{QUARTILES},{poisson(20)},
sums AS (
  SELECT rfm_quartile, r, {SUMS} FROM quart JOIN drawn USING (customer_id) GROUP BY ALL),
{intervals('rfm_quartile', {
    'rate_treated': RATE_T, 'rate_control': RATE_C, 'effect': f'{RATE_T} - {RATE_C}',
})}""",
    "budget_allocation": f"""WITH {SCORED},{PRODUCTS},{PROMOTIONS},{QUARTER},{BUDGET}
SELECT * FROM allocated""",
    "budget_summary": f"""WITH {SCORED},{PRODUCTS},{PROMOTIONS},{QUARTER},{BUDGET}
SELECT promotion_id, count(*) AS n_customers, CAST(sum(profit) AS BIGINT) AS profit_cents,
       CAST(sum(spend) AS BIGINT) AS spend_cents
FROM allocated GROUP BY 1""",
    "checked_catalog": f"""WITH {SUBDAY},{PROMOTIONS}
SELECT 'transactions' AS table_name, count(*) FILTER (WHERE day(datetime) NOT IN (13, 14)) AS n_rows,
       count(*) FILTER (WHERE day(datetime) IN (13, 14)) AS n_rejected
FROM tx
UNION ALL SELECT 'promotions', count(*), 0 FROM promo""",
}
SQL["append_campaign_twice"] = SQL["append_campaign"]
SQL["published_list"] = SQL["targeting_list"]
