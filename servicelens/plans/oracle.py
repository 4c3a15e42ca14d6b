"""DuckDB SQL oracles for the registered queries.

Each string is self-contained: it rebuilds the ``assets`` and ``lines``
views from the star tables (same mapping as ``sources.star``) and computes
the query independently of the Spark code.
"""

from __future__ import annotations

PREFIX = """
WITH assets AS (
  SELECT c_custkey AS asset_id,
         c_custkey - CASE WHEN c_custkey % 7 = 6 THEN 1 ELSE 0 END AS customer_id,
         c_name AS owner_name,
         CASE WHEN c_custkey % 10 = 0 THEN '62' ELSE '08' END || CAST(100000000 + c_custkey AS VARCHAR) AS phone,
         'BK ' || CAST(c_custkey AS VARCHAR) AS plate,
         'Model ' || CAST(c_custkey % 19 AS VARCHAR) AS model,
         'Trim ' || CAST(c_nationkey AS VARCHAR) AS trim,
         CAST(1985 + c_custkey % 10 AS INTEGER) AS model_year,
         CASE c_custkey % 3 WHEN 0 THEN 'Petrol' WHEN 1 THEN 'Diesel' WHEN 2 THEN 'Hybrid' END AS fuel,
         CASE c_nationkey % 3 WHEN 0 THEN 'FWD' WHEN 1 THEN 'RWD' WHEN 2 THEN '4x4' END AS drive,
         CASE c_custkey % 4 WHEN 0 THEN 'Mineral' WHEN 1 THEN 'Semi-Synthetic' ELSE 'Full-Synthetic' END AS oil_type,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 4500 WHEN 'BUILDING' THEN 6000 WHEN 'FURNITURE' THEN 7000
                           WHEN 'HOUSEHOLD' THEN 9500 WHEN 'MACHINERY' THEN 10000 END AS interval_km,
         c_mktsegment AS segment,
         300.0 + abs(c_acctbal) % 2000.0 AS km_per_month
  FROM customer
),
lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_id,
         l_orderkey AS visit_id,
         o_custkey AS asset_id,
         CAST(o_orderdate AS DATE) AS visit_date,
         CAST(floor(1000 + (CAST(o_orderdate AS DATE) - DATE '1995-01-01') * (300.0 + abs(c_acctbal) % 2000.0) / 30) AS BIGINT) AS meter_km,
         n_name AS branch,
         s_name AS technician,
         p_type AS category,
         p_brand AS item,
         CAST(trunc(l_quantity) AS INTEGER) AS qty,
         l_extendedprice AS price,
         coalesce(p_type = 'PROMO', false) AS is_anchor
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey
)
"""

# snippets reused by several oracles
FIRST_LINE = "first({c} ORDER BY line_id, branch, technician, price) FILTER (WHERE {c} IS NOT NULL)"
MONEY_SUM = "CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"

VISITS = """,
visits AS (
  SELECT visit_id,
         {asset} AS asset_id,
         min(visit_date) AS visit_date,
         max(meter_km) AS meter_km,
         {branch} AS branch,
         {tech} AS technician,
         {rev} AS visit_revenue,
         sum(CAST(price AS DECIMAL(18,2))) AS visit_revenue_d,
         list_sort(list(DISTINCT item) FILTER (WHERE item IS NOT NULL)) AS items,
         bool_or(is_anchor) AS has_anchor,
         CAST(count(DISTINCT item) AS INTEGER) AS n_items
  FROM lines WHERE visit_id IS NOT NULL GROUP BY visit_id
)""".format(asset=FIRST_LINE.format(c="asset_id"), branch=FIRST_LINE.format(c="branch"),
            tech=FIRST_LINE.format(c="technician"), rev=MONEY_SUM.format(c="price"))

SQL: dict[str, str] = {}


def sql(name: str, body: str, *, visits: bool = False) -> None:
    SQL[name] = PREFIX + (VISITS if visits else "") + body


sql("asset_master", """
SELECT * FROM assets
""")

sql("service_lines", """
SELECT line_id, visit_id, asset_id, CAST(visit_date AS VARCHAR) AS visit_date, meter_km, branch, technician,
       category, item, qty, price, is_anchor
FROM lines
""")

sql("visit_rollup", """
SELECT v.visit_id, v.asset_id, CAST(v.visit_date AS VARCHAR) AS visit_date, v.meter_km, v.branch, v.technician,
       v.visit_revenue, array_to_string(v.items, '|') AS items, v.has_anchor, v.n_items,
       a.customer_id, a.segment,
       strftime(v.visit_date, '%Y-%m') AS year_month,
       CAST(CAST(date_trunc('week', v.visit_date - 1) AS DATE) + 1 AS VARCHAR) AS week_start,
       CAST(CAST(date_trunc('week', v.visit_date - 1) AS DATE) + 7 AS VARCHAR) AS week_label
FROM visits v LEFT JOIN assets a USING (asset_id)
""", visits=True)

sql("kpi_summary", """,
t AS (SELECT count(*) AS service_item_rows, min(visit_date) AS date_min, max(visit_date) AS date_max,
             sum(CAST(price AS DECIMAL(18,2))) AS total_d,
             coalesce(sum(CAST(price AS DECIMAL(18,2))) FILTER (WHERE is_anchor), 0) AS anchor_d
      FROM lines),
v AS (SELECT count(*) AS visits, count(*) FILTER (WHERE a) AS anchor_visits
      FROM (SELECT visit_id, bool_or(is_anchor) AS a FROM lines WHERE visit_id IS NOT NULL GROUP BY visit_id)),
a AS (SELECT count(DISTINCT customer_id) AS customers, count(DISTINCT asset_id) AS cars FROM assets)
SELECT a.customers, a.cars, v.visits, t.service_item_rows,
       CAST(t.date_min AS VARCHAR) AS date_min, CAST(t.date_max AS VARCHAR) AS date_max,
       CAST(t.total_d AS DOUBLE) AS total_revenue,
       CAST(t.anchor_d AS DOUBLE) AS anchor_revenue,
       CAST(t.total_d - t.anchor_d AS DOUBLE) AS cross_sell_revenue,
       CAST(t.total_d - t.anchor_d AS DOUBLE) / CAST(t.total_d AS DOUBLE) AS cross_sell_share,
       CAST(t.total_d AS DOUBLE) / CAST(v.visits AS DOUBLE) AS avg_order_value,
       v.anchor_visits
FROM t, v, a
""")

sql("kpi_long", """,
t AS (SELECT count(*) AS service_item_rows, min(visit_date) AS date_min, max(visit_date) AS date_max,
             sum(CAST(price AS DECIMAL(18,2))) AS total_d,
             coalesce(sum(CAST(price AS DECIMAL(18,2))) FILTER (WHERE is_anchor), 0) AS anchor_d
      FROM lines),
v AS (SELECT count(*) AS visits, count(*) FILTER (WHERE a) AS anchor_visits
      FROM (SELECT visit_id, bool_or(is_anchor) AS a FROM lines WHERE visit_id IS NOT NULL GROUP BY visit_id)),
a AS (SELECT count(DISTINCT customer_id) AS customers, count(DISTINCT asset_id) AS cars FROM assets),
k AS (SELECT a.customers, a.cars, v.visits, t.service_item_rows, t.date_min, t.date_max,
             CAST(t.total_d AS DOUBLE) AS total, CAST(t.anchor_d AS DOUBLE) AS anchor,
             CAST(t.total_d - t.anchor_d AS DOUBLE) AS cross, v.anchor_visits
      FROM t, v, a)
SELECT m.metric, m.value, m.value_text FROM k,
LATERAL (VALUES
  ('customers', CAST(k.customers AS DOUBLE), NULL::VARCHAR),
  ('cars', CAST(k.cars AS DOUBLE), NULL),
  ('visits', CAST(k.visits AS DOUBLE), NULL),
  ('service_item_rows', CAST(k.service_item_rows AS DOUBLE), NULL),
  ('date_min', NULL::DOUBLE, CAST(k.date_min AS VARCHAR)),
  ('date_max', NULL::DOUBLE, CAST(k.date_max AS VARCHAR)),
  ('total_revenue', k.total, NULL),
  ('anchor_revenue', k.anchor, NULL),
  ('cross_sell_revenue', k.cross, NULL),
  ('anchor_share', k.anchor / k.total, NULL),
  ('cross_sell_share', k.cross / k.total, NULL),
  ('avg_order_value', k.total / CAST(k.visits AS DOUBLE), NULL),
  ('items_per_visit', CAST(k.service_item_rows AS DOUBLE) / CAST(k.visits AS DOUBLE), NULL),
  ('anchor_visits', CAST(k.anchor_visits AS DOUBLE), NULL),
  ('anchor_visit_share', CAST(k.anchor_visits AS DOUBLE) / CAST(k.visits AS DOUBLE), NULL)
) AS m(metric, value, value_text)
""")

for _key, _name, _avg in (("category", "revenue_by_category", False), ("item", "revenue_by_item", True)):
    sql(_name, f"""
SELECT {_key}, {MONEY_SUM.format(c='price')} AS revenue, count(line_id) AS rows,
       count(DISTINCT visit_id) AS visits,
       {"CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS avg_price," if _avg else ""}
       {MONEY_SUM.format(c='price')} / (SELECT {MONEY_SUM.format(c='price')} FROM lines WHERE {_key} IS NOT NULL) AS revenue_share
FROM lines WHERE {_key} IS NOT NULL GROUP BY {_key}
""")

sql("dataset_summary", """
SELECT (SELECT count(DISTINCT customer_id) FROM assets) AS customers,
       (SELECT count(DISTINCT asset_id) FROM assets) AS cars,
       (SELECT count(DISTINCT visit_id) FROM lines) AS visits,
       count(*) AS lines, CAST(min(visit_date) AS VARCHAR) AS date_min, CAST(max(visit_date) AS VARCHAR) AS date_max,
       CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM lines
""")

sql("segment_distribution", """
SELECT segment, count(*) AS assets FROM assets GROUP BY segment
""")

sql("top_items", """
SELECT item, count(*) AS lines FROM lines WHERE item IS NOT NULL GROUP BY item ORDER BY lines DESC, item LIMIT 10
""")

sql("audit_checks", """,
la AS (SELECT count(*) AS service_rows, count(*) FILTER (WHERE visit_date IS NULL) AS date_missing,
              count(*) FILTER (WHERE price IS NULL) AS price_missing, count(*) FILTER (WHERE price < 0) AS negative_price,
              min(visit_date) AS dmin, max(visit_date) AS dmax FROM lines),
aa AS (SELECT count(*) AS master_rows, count(DISTINCT customer_id) AS customers, count(DISTINCT asset_id) AS cars,
              floor(avg(CAST(starts_with(coalesce(phone, ''), '0') AS INTEGER)) * 100) AS phone_ok FROM assets),
dl AS (SELECT coalesce(sum(n - 1), 0) AS d FROM (SELECT line_id, count(*) AS n FROM lines GROUP BY line_id)),
da AS (SELECT coalesce(sum(n - 1), 0) AS d FROM (SELECT asset_id, count(*) AS n FROM assets GROUP BY asset_id)),
fk AS (SELECT count(*) AS d FROM (SELECT DISTINCT asset_id FROM lines WHERE asset_id IS NOT NULL) l
       WHERE NOT EXISTS (SELECT 1 FROM assets a WHERE a.asset_id = l.asset_id)),
uv AS (SELECT count(DISTINCT visit_id) AS d FROM lines)
SELECT m.* FROM la, aa, dl, da, fk, uv, LATERAL (VALUES
  ('master_rows', CAST(aa.master_rows AS DOUBLE), NULL::VARCHAR, 'rows in the asset master'),
  ('service_rows', CAST(la.service_rows AS DOUBLE), NULL, 'rows in the service lines'),
  ('unique_customers', CAST(aa.customers AS DOUBLE), NULL, 'distinct owners in the master'),
  ('unique_assets', CAST(aa.cars AS DOUBLE), NULL, 'distinct assets in the master'),
  ('unique_visits', CAST(uv.d AS DOUBLE), NULL, 'distinct visits in the service lines'),
  ('date_missing', CAST(la.date_missing AS DOUBLE), NULL, 'service dates that failed to parse'),
  ('price_missing', CAST(la.price_missing AS DOUBLE), NULL, 'prices missing or unparseable'),
  ('negative_price', CAST(la.negative_price AS DOUBLE), NULL, 'negative prices'),
  ('duplicate_line_id', CAST(dl.d AS DOUBLE), NULL, 'repeated line ids'),
  ('duplicate_asset_id', CAST(da.d AS DOUBLE), NULL, 'repeated asset ids in the master'),
  ('fk_missing_asset_id', CAST(fk.d AS DOUBLE), NULL, 'asset ids of the lines missing from the master'),
  ('phone_leading_zero_ok', CAST(aa.phone_ok AS DOUBLE), NULL, 'percent of phone numbers starting with 0'),
  ('min_service_date', NULL, CAST(la.dmin AS VARCHAR), 'first service date'),
  ('max_service_date', NULL, CAST(la.dmax AS VARCHAR), 'last service date')
) AS m("check", value, value_text, description)
""")

sql("audit_status", """,
asof_d AS (SELECT max(visit_date) + 1 AS d FROM lines),
la AS (SELECT count(*) FILTER (WHERE line_id IS NULL) AS missing_id, count(*) FILTER (WHERE price <= 0) AS bad_price,
              count(*) FILTER (WHERE qty <= 0) AS bad_qty,
              count(*) FILTER (WHERE visit_date > (SELECT d FROM asof_d)) AS after_as_of,
              count(*) FILTER (WHERE visit_date < DATE '1995-01-01') AS before_window FROM lines),
aa AS (SELECT count(*) FILTER (WHERE phone IS NULL) AS missing_phone,
              count(*) FILTER (WHERE phone IS NOT NULL AND NOT starts_with(phone, '0')) AS phone_bad FROM assets),
dl AS (SELECT coalesce(sum(n - 1), 0) AS d FROM (SELECT line_id, count(*) AS n FROM lines GROUP BY line_id)),
fk AS (SELECT count(*) AS d FROM (SELECT DISTINCT asset_id FROM lines WHERE asset_id IS NOT NULL) l
       WHERE NOT EXISTS (SELECT 1 FROM assets a WHERE a.asset_id = l.asset_id)),
ex AS (SELECT coalesce(sum(n - 1), 0) AS d FROM (SELECT count(*) AS n FROM lines GROUP BY ALL_COLUMNS_PLACEHOLDER)),
m AS (SELECT v.* FROM la, aa, dl, fk, ex, LATERAL (VALUES
  ('missing_line_id', CAST(la.missing_id AS DOUBLE), ''),
  ('duplicate_line_id', CAST(dl.d AS DOUBLE), ''),
  ('orphan_asset_id', CAST(fk.d AS DOUBLE), ''),
  ('nonpositive_price', CAST(la.bad_price AS DOUBLE), ''),
  ('nonpositive_qty', CAST(la.bad_qty AS DOUBLE), ''),
  ('missing_phone', CAST(aa.missing_phone AS DOUBLE), ''),
  ('phone_not_leading_zero', CAST(aa.phone_bad AS DOUBLE), 'phones must be read as text'),
  ('date_after_as_of', CAST(la.after_as_of AS DOUBLE), ''),
  ('date_before_window', CAST(la.before_window AS DOUBLE), ''),
  ('exact_duplicate_rows', CAST(ex.d AS DOUBLE), '')
) AS v("check", value, notes))
SELECT "check", value, CASE WHEN value = 0 THEN 'PASS' ELSE 'FAIL' END AS status, notes FROM m
""".replace("ALL_COLUMNS_PLACEHOLDER",
            "line_id, visit_id, asset_id, visit_date, meter_km, branch, technician, category, item, qty, price, is_anchor"))

ANCHOR_FIRST = "first({c} ORDER BY line_id, branch, technician, price)"
EPISODES = """,
al AS (SELECT visit_id, {a} AS asset_id, {d} AS visit_date, {m} AS meter_km, {p} AS price
       FROM lines WHERE is_anchor GROUP BY visit_id),
el AS (SELECT al.*, lag(visit_date) OVER w AS prev_date, lag(meter_km) OVER w AS prev_meter_km
       FROM al WINDOW w AS (PARTITION BY asset_id ORDER BY visit_date, meter_km, visit_id)),
eg AS (SELECT el.*, CAST(visit_date - prev_date AS INTEGER) AS gap_days, meter_km - prev_meter_km AS gap_km, 1 AS event
       FROM el),
ep AS (SELECT eg.*, a.model_year, a.fuel, a.drive, a.oil_type, a.interval_km, a.segment, a.km_per_month,
              CAST(year(eg.visit_date) - a.model_year AS INTEGER) AS car_age,
              ln(CAST(gap_days AS DOUBLE)) AS log_gap_days,
              gap_km / a.interval_km AS utilization
       FROM eg LEFT JOIN assets a USING (asset_id)
       WHERE gap_days > 0 AND gap_days <= 500 AND gap_km > 0)""".format(
    a=ANCHOR_FIRST.format(c="asset_id"), d=ANCHOR_FIRST.format(c="visit_date"),
    m=ANCHOR_FIRST.format(c="meter_km"), p=ANCHOR_FIRST.format(c="price"))

sql("anchor_lines", EPISODES + """
SELECT visit_id, asset_id, CAST(visit_date AS VARCHAR) AS visit_date, meter_km, price FROM al
""")

sql("episode_lag", EPISODES + """
SELECT visit_id, asset_id, CAST(visit_date AS VARCHAR) AS visit_date, meter_km, price,
       CAST(prev_date AS VARCHAR) AS prev_date, prev_meter_km, gap_days, gap_km, event FROM eg
""")

sql("episodes", EPISODES + """
SELECT asset_id, visit_id, CAST(visit_date AS VARCHAR) AS visit_date, meter_km, price,
       CAST(prev_date AS VARCHAR) AS prev_date, prev_meter_km, gap_days, gap_km, event,
       model_year, fuel, drive, oil_type, interval_km, segment, km_per_month, car_age,
       round(log_gap_days, 6) AS log_gap_days, utilization FROM ep
""")

sql("raw_gap_by_segment", """,
pa AS (SELECT asset_id, CAST(max(visit_date) - min(visit_date) AS BIGINT) AS span, count(*) - 1 AS gaps
       FROM lines WHERE is_anchor AND asset_id IS NOT NULL AND visit_date IS NOT NULL GROUP BY asset_id)
SELECT segment, CAST(sum(gaps) AS BIGINT) AS n_gaps,
       CASE WHEN sum(gaps) = 0 THEN NULL ELSE CAST(sum(span) AS DOUBLE) / CAST(sum(gaps) AS DOUBLE) END AS avg_gap_days
FROM pa JOIN assets USING (asset_id) GROUP BY segment
""")

LAST_ANCHOR = """,
la AS (SELECT asset_id,
              first(visit_date ORDER BY visit_date DESC, line_id DESC, branch DESC, technician DESC, price DESC) AS last_anchor_date,
              first(meter_km ORDER BY visit_date DESC, line_id DESC, branch DESC, technician DESC, price DESC) AS last_anchor_km,
              first(visit_id ORDER BY visit_date DESC, line_id DESC, branch DESC, technician DESC, price DESC) AS last_anchor_visit_id
       FROM lines WHERE is_anchor AND asset_id IS NOT NULL GROUP BY asset_id)"""

sql("last_anchor", LAST_ANCHOR + """
SELECT asset_id, CAST(last_anchor_date AS VARCHAR) AS last_anchor_date, last_anchor_km, last_anchor_visit_id FROM la
""")

ALERTS = EPISODES + LAST_ANCHOR + """,
seg AS (SELECT segment, median(gap_days) AS segment_interval FROM ep WHERE segment IS NOT NULL GROUP BY segment),
b0 AS (SELECT a.*, la.last_anchor_date, la.last_anchor_km,
              CAST((SELECT max(visit_date) + 1 FROM lines) - la.last_anchor_date AS INTEGER) AS days_since_last_anchor,
              coalesce(seg.segment_interval, (SELECT median(gap_days) FROM ep)) AS predicted_interval_days
       FROM assets a LEFT JOIN la USING (asset_id) LEFT JOIN seg USING (segment)),
b1 AS (SELECT *, days_since_last_anchor * km_per_month / 30.0 AS est_km_since_last_anchor FROM b0),
b2 AS (SELECT *, days_since_last_anchor / predicted_interval_days AS progress_day,
              est_km_since_last_anchor / interval_km AS progress_km FROM b1),
b3 AS (SELECT *, CAST(0.55 AS DOUBLE) * progress_day + CAST(0.45 AS DOUBLE) * progress_km AS combined FROM b2),
b4 AS (SELECT *, 1.0 / (1.0 + exp(-10.0 * (combined - CAST(0.9 AS DOUBLE)))) AS due_probability FROM b3),
b5 AS (SELECT *, CASE WHEN s IS NULL THEN NULL ELSE least(greatest(s, 0.0), 100.0) END AS priority_score
       FROM (SELECT *, 100.0 * (CAST(0.45 AS DOUBLE) * due_probability + CAST(0.35 AS DOUBLE) * combined
                                + CAST(0.2 AS DOUBLE) * progress_km) AS s FROM b4)),
alerts AS (
  SELECT customer_id, owner_name, phone, asset_id, plate, model, trim, fuel, drive, oil_type, interval_km, segment,
         CAST(last_anchor_date AS VARCHAR) AS last_anchor_date, last_anchor_km, days_since_last_anchor,
         est_km_since_last_anchor, predicted_interval_days, progress_day, progress_km,
         round(due_probability, 6) AS due_probability, round(priority_score, 6) AS priority_score,
         CASE WHEN priority_score >= 85 THEN 'Critical' WHEN priority_score >= 70 THEN 'High Priority'
              WHEN priority_score >= 55 THEN 'Warm Reminder' ELSE 'Monitor' END AS alert_tier,
         'Hello ' || string_split_regex(trim(owner_name), '\\s+')[1] || ', your ' || model || ' ' || plate
           || ' has reached about '
           || CAST(CAST(round_even(CASE WHEN progress_day IS NULL THEN NULL WHEN progress_km IS NULL THEN progress_day
                                      ELSE greatest(progress_day, progress_km) END * 100.0, 0) AS BIGINT) AS VARCHAR)
           || '% of its recommended service interval. Reply to this message to book a service slot.' AS reminder_message
  FROM b5)"""

sql("alert_ranking", ALERTS + """
SELECT * FROM alerts
""")

sql("tier_distribution", ALERTS + """
SELECT t.alert_tier, coalesce(c.n, 0) AS assets
FROM (VALUES (0, 'Critical'), (1, 'High Priority'), (2, 'Warm Reminder'), (3, 'Monitor')) AS t(ord, alert_tier)
LEFT JOIN (SELECT alert_tier, count(*) AS n FROM alerts GROUP BY alert_tier) c USING (alert_tier)
""")

BASKET = """,
ntx AS (SELECT count(DISTINCT visit_id) AS n FROM lines WHERE visit_id IS NOT NULL),
vi AS (SELECT DISTINCT visit_id, item FROM lines WHERE visit_id IS NOT NULL AND item IS NOT NULL),
ic AS (SELECT item, count(*) AS visits FROM vi GROUP BY item),
fr AS (SELECT item FROM ic WHERE visits / (SELECT n FROM ntx) >= 0.02),
fv AS (SELECT * FROM vi WHERE item IN (SELECT item FROM fr)),
f1 AS (SELECT item AS i1, visits AS freq FROM ic WHERE item IN (SELECT item FROM fr)),
f2 AS (SELECT a.item AS i1, b.item AS i2, count(*) AS freq FROM fv a JOIN fv b ON a.visit_id = b.visit_id AND a.item < b.item
       GROUP BY 1, 2 HAVING count(*) / (SELECT n FROM ntx) >= 0.02),
f3 AS (SELECT a.item AS i1, b.item AS i2, c.item AS i3, count(*) AS freq
       FROM fv a JOIN fv b ON a.visit_id = b.visit_id AND a.item < b.item
                 JOIN fv c ON a.visit_id = c.visit_id AND b.item < c.item
       GROUP BY 1, 2, 3 HAVING count(*) / (SELECT n FROM ntx) >= 0.02),
fi AS (SELECT [i1] AS items, freq FROM f1 UNION ALL SELECT [i1, i2], freq FROM f2 UNION ALL SELECT [i1, i2, i3], freq FROM f3),
ip AS (SELECT item, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS avg_price
       FROM lines WHERE item IS NOT NULL GROUP BY item)"""

sql("frequent_itemsets", BASKET + """
SELECT array_to_string(items, '|') AS items, freq, CAST(len(items) AS INTEGER) AS size, freq / (SELECT n FROM ntx) AS support
FROM fi
""")

SQL["weighted_itemsets"] = SQL["frequent_itemsets"]

sql("association_rules", BASKET + """,
sp AS (SELECT [i1] AS ant, [i2] AS con, freq FROM f2 UNION ALL SELECT [i2], [i1], freq FROM f2
       UNION ALL SELECT [i1], [i2, i3], freq FROM f3 UNION ALL SELECT [i2], [i1, i3], freq FROM f3
       UNION ALL SELECT [i3], [i1, i2], freq FROM f3 UNION ALL SELECT [i1, i2], [i3], freq FROM f3
       UNION ALL SELECT [i1, i3], [i2], freq FROM f3 UNION ALL SELECT [i2, i3], [i1], freq FROM f3),
r0 AS (SELECT sp.ant, sp.con, sp.freq / (SELECT n FROM ntx) AS support,
              fa.freq / (SELECT n FROM ntx) AS sa, fc.freq / (SELECT n FROM ntx) AS sc
       FROM sp JOIN fi fa ON fa.items = sp.ant JOIN fi fc ON fc.items = sp.con),
r1 AS (SELECT *, support / sa AS confidence FROM r0),
r2 AS (SELECT *, confidence / sc AS lift, support - sa * sc AS leverage,
              CASE WHEN confidence = 1.0 THEN 'inf'::DOUBLE ELSE (1.0 - sc) / (1.0 - confidence) END AS conviction
       FROM r1 WHERE confidence / sc >= 1.05),
cp AS (SELECT con, avg(coalesce(ip.avg_price, 0.0)) AS consequent_avg_price
       FROM (SELECT DISTINCT con FROM r2) x, unnest(x.con) AS u(item) LEFT JOIN ip ON ip.item = u.item GROUP BY con),
r3 AS (SELECT r2.*, cp.consequent_avg_price, CAST(round_even(support * (SELECT n FROM ntx), 0) AS BIGINT) AS support_count
       FROM r2 LEFT JOIN cp USING (con))
SELECT array_to_string(ant, ' + ') AS antecedents_txt, array_to_string(con, ' + ') AS consequents_txt,
       support, support_count, confidence, lift, leverage, conviction, consequent_avg_price,
       support_count * confidence * consequent_avg_price AS estimated_rule_revenue
FROM r3
""")

PAIRWISE = BASKET + """,
nd AS (SELECT CAST(n AS DOUBLE) AS n FROM ntx),
pc AS (SELECT a.item AS antecedent, b.item AS consequent, count(*) AS cooccurrence_visits
       FROM fv a JOIN fv b ON a.visit_id = b.visit_id AND a.item <> b.item GROUP BY 1, 2),
p0 AS (SELECT pc.*, ca.visits AS antecedent_visits, cb.visits AS consequent_visits,
              cooccurrence_visits / (SELECT n FROM nd) AS support,
              ca.visits / (SELECT n FROM nd) AS sa, cb.visits / (SELECT n FROM nd) AS sb
       FROM pc JOIN ic ca ON ca.item = pc.antecedent JOIN ic cb ON cb.item = pc.consequent),
p1 AS (SELECT *, support / sa AS confidence FROM p0 WHERE support >= 0.02),
p2 AS (SELECT *, confidence / sb AS lift, support - sa * sb AS leverage FROM p1 WHERE confidence / sb >= 1.05),
p3 AS (SELECT p2.*, coalesce(ip.avg_price, 0.0) AS consequent_avg_price,
              CAST(round_even(support * (SELECT n FROM nd), 0) AS BIGINT) AS support_count
       FROM p2 LEFT JOIN ip ON ip.item = p2.consequent),
rules AS (
  SELECT antecedent, consequent, support, support_count, confidence, lift, leverage, NULL::DOUBLE AS conviction,
         antecedent_visits, cooccurrence_visits, antecedent_visits - cooccurrence_visits AS potential_visits_without_consequent,
         consequent_avg_price, support_count * confidence * consequent_avg_price AS estimated_rule_revenue,
         (antecedent_visits - cooccurrence_visits) * confidence * consequent_avg_price AS estimated_rule_revenue_if_targeted
  FROM p3)"""

sql("pairwise_rules", PAIRWISE + """
SELECT * FROM rules
""")

sql("top_pair_rules", PAIRWISE + """
SELECT antecedent || ' → ' || consequent AS rule, antecedent, consequent, estimated_rule_revenue, lift, confidence
FROM rules ORDER BY estimated_rule_revenue DESC, lift DESC, confidence DESC, antecedent, consequent LIMIT 10
""")

SQL["top_rules"] = f"""
SELECT antecedents_txt || ' → ' || consequents_txt AS rule, antecedents_txt AS antecedent, consequents_txt AS consequent,
       estimated_rule_revenue, lift, confidence FROM ({SQL["association_rules"]})
ORDER BY estimated_rule_revenue DESC, lift DESC, confidence DESC, antecedent, consequent LIMIT 10
"""

sql("amount_contract", """
SELECT count(price) AS prices, count(*) FILTER (WHERE price IS NOT NULL AND (isnan(price) OR abs(price) >= 1e16)) AS prices_left_out,
       count(*) FILTER (WHERE abs(price) < 1e16 AND CAST(CAST(price AS DECIMAL(18,2)) AS DOUBLE) <> price) AS prices_rounded FROM lines
""")

sql("baskets", """
SELECT visit_id, array_to_string(list_sort(list(DISTINCT item) FILTER (WHERE item IS NOT NULL)), '|') AS items
FROM lines WHERE visit_id IS NOT NULL GROUP BY visit_id
""")

sql("item_price_stats", """
SELECT item, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS avg_price
FROM lines WHERE item IS NOT NULL GROUP BY item
""")

ATTACH = """,
av AS (SELECT DISTINCT visit_id FROM lines WHERE is_anchor AND visit_id IS NOT NULL),
ar AS (SELECT item, count(DISTINCT visit_id) / (SELECT count(*) FROM av) AS attach_rate,
              count(DISTINCT visit_id) AS visits_with_item,
              CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS revenue_in_anchor_visits,
              CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS avg_price
       FROM lines WHERE NOT is_anchor AND item IS NOT NULL AND visit_id IN (SELECT visit_id FROM av) GROUP BY item)"""

sql("attach_rates", ATTACH + """
SELECT * FROM ar
""")

sql("attach_rates_full", ATTACH + """
SELECT i.item, coalesce(ar.attach_rate, 0.0) AS attach_rate, coalesce(ar.visits_with_item, 0) AS visits_with_item,
       i.avg_price, coalesce(ar.revenue_in_anchor_visits, 0.0) AS revenue_in_anchor_visits
FROM (SELECT item, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS avg_price
      FROM lines WHERE item IS NOT NULL AND NOT is_anchor GROUP BY item) i
LEFT JOIN ar USING (item)
""")

sql("conditional_item_rate", ATTACH + """
SELECT item, count(DISTINCT visit_id) AS anchor_visits_with_item, count(DISTINCT visit_id) / (SELECT count(*) FROM av) AS rate
FROM lines WHERE item IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4') AND visit_id IN (SELECT visit_id FROM av)
GROUP BY item
""")


HOLIDAYS_SQL = "[DATE '1995-03-03', DATE '1996-02-21', DATE '1997-02-09', DATE '1998-01-30', DATE '1999-01-19', DATE '2000-01-08', DATE '2000-12-27', DATE '2001-12-16']"

WEEKLY = VISITS + """,
wk AS (SELECT 'ALL' AS series, CAST(date_trunc('week', visit_date - 1) AS DATE) + 7 AS week, count(*) AS visits,
              count(*) FILTER (WHERE has_anchor) AS anchor_visits, sum(visit_revenue_d) AS revenue
       FROM visits WHERE visit_date IS NOT NULL GROUP BY 1, 2),
cal AS (SELECT series, CAST(unnest(generate_series(CAST(min(week) AS TIMESTAMP), CAST(max(week) AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week
        FROM wk GROUP BY series),
dense AS (SELECT c.series, c.week, coalesce(w.visits, 0) AS visits, coalesce(w.anchor_visits, 0) AS anchor_visits,
                 coalesce(w.revenue, 0) AS revenue
          FROM cal c LEFT JOIN wk w USING (series, week)),
hol AS (SELECT unnest(""" + HOLIDAYS_SQL + """) AS h),
dth AS (SELECT week, min(h - week) FILTER (WHERE h - week >= -3) AS dt FROM (SELECT DISTINCT week FROM dense), hol GROUP BY week),
calf AS (SELECT d.series, d.week, CAST(weekofyear(d.week) AS INTEGER) AS week_of_year, CAST(month(d.week) AS INTEGER) AS month,
                CAST(month(d.week) IN (11, 12) AS INTEGER) AS is_year_end,
                CAST(day(d.week) <= 7 OR day(d.week) >= 25 AS INTEGER) AS payday_week,
                coalesce(CAST(dth.dt > 0 AND dth.dt <= 28 AS INTEGER), 0) AS pre_holiday_4w,
                coalesce(CAST(dth.dt >= -3 AND dth.dt <= 7 AS INTEGER), 0) AS holiday_week
         FROM dense d LEFT JOIN dth USING (week)),
lf0 AS (SELECT d.*, CAST(lag(visits, 1) OVER w AS DOUBLE) AS lag_1, CAST(lag(visits, 2) OVER w AS DOUBLE) AS lag_2,
               CAST(lag(visits, 3) OVER w AS DOUBLE) AS lag_3, CAST(lag(visits, 4) OVER w AS DOUBLE) AS lag_4,
               CAST(lag(visits, 8) OVER w AS DOUBLE) AS lag_8, CAST(lag(visits, 12) OVER w AS DOUBLE) AS lag_12,
               CASE WHEN count(visits) OVER w4 = 4 THEN avg(CAST(visits AS DOUBLE)) OVER w4 END AS roll4_mean,
               CASE WHEN count(visits) OVER w8 = 8 THEN avg(CAST(visits AS DOUBLE)) OVER w8 END AS roll8_mean,
               c.week_of_year, c.month, c.is_year_end, c.payday_week, c.pre_holiday_4w, c.holiday_week,
               CAST(visits AS DOUBLE) AS y
        FROM dense d JOIN calf c USING (series, week)
        WINDOW w AS (PARTITION BY series ORDER BY week),
               w4 AS (PARTITION BY series ORDER BY week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING),
               w8 AS (PARTITION BY series ORDER BY week ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)),
lf AS (SELECT * FROM lf0 WHERE lag_12 IS NOT NULL AND roll8_mean IS NOT NULL AND lag_1 IS NOT NULL),
sp AS (SELECT lf.*, row_number() OVER (PARTITION BY series ORDER BY week DESC)
                    <= least(12, greatest(4, floor(count(*) OVER (PARTITION BY series) / 6))) AS is_test FROM lf)"""

sql("weekly_demand", WEEKLY + """
SELECT series, CAST(week AS VARCHAR) AS week, visits, anchor_visits, CAST(revenue AS DOUBLE) AS revenue FROM dense
""")

sql("branch_weekly_demand", (WEEKLY.replace("SELECT 'ALL' AS series,", "SELECT coalesce(CAST(branch AS VARCHAR), '') AS series,")) + """
SELECT series, CAST(week AS VARCHAR) AS week, visits, anchor_visits, CAST(revenue AS DOUBLE) AS revenue FROM dense
""")

FIRST_CATEGORY = """,
vc AS (SELECT visit_id, first(category ORDER BY line_id, branch, technician, price) AS category
       FROM lines WHERE category IS NOT NULL GROUP BY visit_id)"""

sql("category_weekly_demand", FIRST_CATEGORY + (
    WEEKLY.replace("SELECT 'ALL' AS series,", "SELECT coalesce(CAST(category AS VARCHAR), '') AS series,")
    .replace("FROM visits WHERE", "FROM visits LEFT JOIN vc USING (visit_id) WHERE")) + """
SELECT series, CAST(week AS VARCHAR) AS week, visits, anchor_visits, CAST(revenue AS DOUBLE) AS revenue FROM dense
""")

sql("calendar_features", WEEKLY + """
SELECT series, CAST(week AS VARCHAR) AS week, week_of_year, month, is_year_end, payday_week, pre_holiday_4w, holiday_week
FROM calf
""")

sql("lag_features", WEEKLY + """
SELECT series, CAST(week AS VARCHAR) AS week, visits, anchor_visits, lag_1, lag_2, lag_3, lag_4, lag_8, lag_12,
       roll4_mean, roll8_mean, week_of_year, month, is_year_end, payday_week, pre_holiday_4w, holiday_week, y, is_test
FROM sp
""")

NAIVE = WEEKLY + """,
nb AS (SELECT series, CASE WHEN count(*) = 4 THEN avg(y) END AS naive
       FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY week DESC) AS rk FROM sp WHERE NOT is_test)
       WHERE rk <= 4 GROUP BY series),
te AS (SELECT sp.*, nb.naive FROM sp LEFT JOIN nb USING (series) WHERE is_test),
mp AS (SELECT series, avg(abs(y - naive) / abs(y)) FILTER (WHERE y <> 0) AS mape_naive FROM te GROUP BY series)"""

sql("naive_backtest", NAIVE + """
SELECT series, CAST(week AS VARCHAR) AS week, visits AS actual_visits,
       CAST(round_even(naive, 0) AS BIGINT) AS pred_visits_naive, round(mape_naive, 6) AS mape_naive
FROM te LEFT JOIN mp USING (series)
""")



def _eliminated(name, k):
    """CTEs that solve the normal equations of the long table ``name``0 (series, i, j, v): one step a pivot."""
    steps = ""
    for p in range(1, k + 1):
        steps += f""",
{name}{p} AS (
  SELECT c.series, c.i, c.j,
         CASE WHEN c.i = {p} AND ok THEN c.v / pv WHEN c.i = {p} THEN 0.0
              WHEN ok THEN c.v - ci.v * rj.v / pv ELSE c.v END AS v
  FROM {name}{p - 1} c
  JOIN (SELECT a.series, a.v AS pv, a.v > 1e-9 * b.v AS ok
        FROM {name}{p - 1} a JOIN {name}0 b USING (series, i, j) WHERE a.i = {p} AND a.j = {p}) p USING (series)
  JOIN {name}{p - 1} ci ON ci.series = c.series AND ci.i = c.i AND ci.j = {p}
  JOIN {name}{p - 1} rj ON rj.series = c.series AND rj.i = {p} AND rj.j = c.j)"""
    return steps


def _exog_ar(series):
    """Two-stage least squares in long form: products by unnested regressors, eliminated, joined back."""
    weekly = NAIVE.replace("SELECT 'ALL' AS series,", f"SELECT {series} AS series,")
    return weekly + """,
xt AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY week) - 1 AS t FROM sp),
xl AS (SELECT series, week, is_test, unnest([1, 2, 3, 4, 5, 6, 7]) AS i,
              unnest([1.0::DOUBLE, t, is_year_end, payday_week, pre_holiday_4w, holiday_week, y]) AS x FROM xt),
s0 AS (SELECT a.series, a.i, b.i AS j, sum(a.x * b.x) AS v FROM xl a JOIN xl b USING (series, week)
       WHERE NOT a.is_test AND a.i <= 6 GROUP BY ALL)""" + _eliminated("s", 6) + """,
fit AS (SELECT series, week, sum(v * x ORDER BY i) AS fit FROM xl JOIN (SELECT series, i, v FROM s6 WHERE j = 7) USING (series, i)
        GROUP BY series, week),
res AS (SELECT xt.*, fit.fit, y - fit.fit AS u, lag(y - fit.fit, 1) OVER w AS u1, lag(y - fit.fit, 4) OVER w AS u4
        FROM xt LEFT JOIN fit USING (series, week) WINDOW w AS (PARTITION BY series ORDER BY week)),
ul AS (SELECT series, week, unnest([1, 2, 3]) AS i, unnest([u1, u4, u]) AS x FROM res WHERE NOT is_test AND u4 IS NOT NULL),
r0 AS (SELECT a.series, a.i, b.i AS j, sum(a.x * b.x) AS v FROM ul a JOIN ul b USING (series, week) WHERE a.i <= 2 GROUP BY ALL)
""" + _eliminated("r", 2) + """,
rho AS (SELECT series, max(v) FILTER (WHERE i = 1) AS p1, max(v) FILTER (WHERE i = 2) AS p4 FROM r2 WHERE j = 3 GROUP BY series),
ep AS (SELECT res.series, res.week, res.visits, res.y, nb.naive,
              CASE WHEN fit IS NOT NULL THEN greatest(fit + coalesce(p1 * coalesce(u1, 0) + p4 * coalesce(u4, 0), 0), 0) END AS pred
       FROM res LEFT JOIN rho USING (series) LEFT JOIN nb USING (series) WHERE is_test),
em AS (SELECT series, avg(abs(y - pred) / abs(y)) FILTER (WHERE y <> 0) AS mape_exog,
              avg(abs(y - naive) / abs(y)) FILTER (WHERE y <> 0) AS mape_naive FROM ep GROUP BY series)"""


sql("exog_ar_backtest", _exog_ar("coalesce(CAST(branch AS VARCHAR), '')") + """
SELECT series, CAST(week AS VARCHAR) AS week, visits AS actual_visits, CAST(round_even(pred, 0) AS BIGINT) AS pred_visits_exog,
       round(pred, 6) AS pred_exog_raw, round(mape_exog, 6) AS mape_exog, round(mape_naive, 6) AS mape_naive
FROM ep JOIN em USING (series)
""")

sql("exog_ar_mape", _exog_ar("'ALL'") + """
SELECT series, 'naive trailing 4-week mean' AS model, round(mape_naive, 6) AS test_mape FROM em
UNION ALL
SELECT series, 'calendar regression with autoregressive errors', round(mape_exog, 6) FROM em
""")

sql("recursive_forecast_naive", WEEKLY + """,
hs AS (SELECT series, list(CAST(visits AS DOUBLE) ORDER BY week) AS h, max(week) AS last_week,
              sum(visits) AS tv, sum(anchor_visits) AS ta, sum(revenue) AS tr FROM dense GROUP BY series),
rec AS (
  SELECT series, 0 AS step, h, NULL::DOUBLE AS pred FROM hs
  UNION ALL
  SELECT series, step + 1, list_append(h, p), p
  FROM (SELECT *, greatest((h[-4] + h[-3] + h[-2] + h[-1]) / 4, 0.0) AS p FROM rec WHERE step < 8)
),
f AS (SELECT r.series, CAST(hs.last_week + 7 * r.step AS DATE) AS week, r.pred,
             CAST(round_even(r.pred, 0) AS BIGINT) AS fv,
             CAST(hs.ta AS DOUBLE) / greatest(CAST(hs.tv AS DOUBLE), 1.0) AS ar,
             CAST(hs.tr AS DOUBLE) / greatest(CAST(hs.tv AS DOUBLE), 1.0) AS aov
      FROM rec r JOIN hs USING (series) WHERE r.step >= 1)
SELECT series, CAST(week AS VARCHAR) AS week, pred AS forecast_mean, fv AS forecast_visits,
       CAST(round_even(fv * ar, 0) AS BIGINT) AS forecast_anchor_visits,
       CAST(round_even(fv * aov, 0) AS BIGINT) AS forecast_revenue,
       'naive trailing 4-week mean' AS method
FROM f
""")

SQL["recursive_forecast_naive"] = SQL["recursive_forecast_naive"].replace("WITH assets AS", "WITH RECURSIVE assets AS", 1)


CUSTOMERS = """,
vf AS (SELECT v.*, a.customer_id, a.owner_name, a.phone FROM visits v LEFT JOIN assets a USING (asset_id)),
c0 AS (SELECT customer_id,
              first(owner_name ORDER BY visit_id) FILTER (WHERE owner_name IS NOT NULL) AS customer_name,
              first(phone ORDER BY visit_id) FILTER (WHERE phone IS NOT NULL) AS phone,
              count(DISTINCT asset_id) AS assets, count(*) AS visits,
              CAST(sum(visit_revenue_d) AS DOUBLE) AS revenue, min(visit_date) AS first_visit, max(visit_date) AS last_visit,
              count(*) FILTER (WHERE has_anchor) AS anchor_visits
       FROM vf WHERE customer_id IS NOT NULL GROUP BY customer_id),
c1 AS (SELECT *, CAST((SELECT max(visit_date) + 1 FROM lines) - last_visit AS INTEGER) AS days_since_last_visit,
              CAST(greatest(last_visit - first_visit, 30) AS INTEGER) AS tenure_days FROM c0),
cust AS (SELECT customer_id, customer_name, phone, assets, visits, revenue,
                CAST(first_visit AS VARCHAR) AS first_visit, CAST(last_visit AS VARCHAR) AS last_visit, anchor_visits,
                days_since_last_visit, tenure_days, revenue / tenure_days * 365.0::DOUBLE AS annualized_revenue,
                revenue / visits AS avg_visit_revenue,
                CASE WHEN days_since_last_visit IS NULL THEN NULL
                     ELSE least(greatest(days_since_last_visit / 240.0::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) END AS recency_risk
         FROM c1),
vs0 AS (SELECT cust.*,
               CASE WHEN annualized_revenue IS NULL THEN NULL ELSE
                 (CAST(2 * rank() OVER (ORDER BY annualized_revenue) + count(*) OVER (PARTITION BY annualized_revenue) - 1 AS DOUBLE) / 2.0::DOUBLE)
                 / CAST((SELECT count(annualized_revenue) FROM cust) AS DOUBLE) END AS pct
        FROM cust),
vs AS (SELECT *, 100.0::DOUBLE * pct AS value_score, 100.0::DOUBLE * recency_risk AS risk_score,
              0.6::DOUBLE * (100.0::DOUBLE * pct) + 0.4::DOUBLE * (100.0::DOUBLE * recency_risk) AS priority_reactivation_score
       FROM vs0),
vq AS (SELECT vs.*, CAST(ntile(4) OVER (ORDER BY revenue, customer_id) AS INTEGER) AS value_quartile FROM vs),
vseg AS (SELECT vq.*, CASE value_quartile WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' WHEN 3 THEN 'High' WHEN 4 THEN 'VIP' END AS value_segment,
                CASE WHEN value_quartile >= 3 AND recency_risk >= 0.5 THEN 'reactivation campaign'
                     WHEN value_quartile >= 3 THEN 'premium service reminder'
                     WHEN recency_risk >= 0.5 THEN 'automated reminder'
                     ELSE 'standard reminder' END AS action
         FROM vq)"""

sql("customer_rollup", CUSTOMERS + """
SELECT * FROM cust
""", visits=True)

sql("value_score", CUSTOMERS + """
SELECT customer_id, annualized_revenue, recency_risk, value_score, risk_score, priority_reactivation_score FROM vs
""", visits=True)

sql("value_segment", CUSTOMERS + """
SELECT customer_id, revenue, recency_risk, value_quartile, value_segment, action FROM vseg
""", visits=True)

ACTIVITY = EPISODES + """,
ca AS (SELECT asset_id, count(*) AS visits, count(*) FILTER (WHERE has_anchor) AS anchor_visits,
              CAST(sum(visit_revenue_d) AS DOUBLE) AS revenue, avg(n_items) AS avg_items,
              min(visit_date) AS first_visit, max(visit_date) AS last_visit
       FROM visits WHERE asset_id IS NOT NULL GROUP BY asset_id),
ca2 AS (SELECT *, CAST(greatest(last_visit - first_visit, 30) AS INTEGER) AS active_days FROM ca),
ca3 AS (SELECT *, visits / active_days * 365.0::DOUBLE AS visits_per_year,
               revenue / active_days * 365.0::DOUBLE AS revenue_per_year FROM ca2),
gm AS (SELECT asset_id, avg(gap_days) AS avg_gap_days, avg(gap_km) AS avg_gap_km FROM ep GROUP BY asset_id),
ft AS (SELECT a.asset_id, a.segment, a.km_per_month,
              coalesce(CAST(ca3.visits AS DOUBLE), 0.0) AS visits, coalesce(CAST(ca3.anchor_visits AS DOUBLE), 0.0) AS anchor_visits,
              coalesce(ca3.revenue, 0.0) AS revenue, coalesce(ca3.avg_items, 0.0) AS avg_items,
              coalesce(ca3.visits_per_year, 0.0) AS visits_per_year, coalesce(ca3.revenue_per_year, 0.0) AS revenue_per_year,
              coalesce(gm.avg_gap_days, 0.0) AS avg_gap_days, coalesce(gm.avg_gap_km, 0.0) AS avg_gap_km,
              coalesce(CAST(a.km_per_month AS DOUBLE), 0.0) AS x_km_per_month,
              coalesce(CAST(a.interval_km AS DOUBLE), 0.0) AS x_interval_km,
              coalesce(CAST(a.model_year AS DOUBLE), 0.0) AS x_model_year
       FROM assets a LEFT JOIN ca3 USING (asset_id) LEFT JOIN gm USING (asset_id)),
ftx AS (SELECT *, visits_per_year AS x_visits_per_year, revenue_per_year AS x_revenue_per_year,
               avg_items AS x_avg_items, avg_gap_days AS x_avg_gap_days FROM ft)"""

sql("car_activity", ACTIVITY + """
SELECT ca3.asset_id, visits, anchor_visits, revenue, avg_items, CAST(first_visit AS VARCHAR) AS first_visit,
       CAST(last_visit AS VARCHAR) AS last_visit, active_days, visits_per_year, revenue_per_year, avg_gap_days, avg_gap_km
FROM ca3 LEFT JOIN gm USING (asset_id)
""", visits=True)

sql("car_features", ACTIVITY + """
SELECT asset_id, segment, visits, anchor_visits, revenue, avg_items, visits_per_year, revenue_per_year, avg_gap_days,
       avg_gap_km, x_km_per_month, x_interval_km, x_model_year, x_visits_per_year, x_revenue_per_year, x_avg_items,
       x_avg_gap_days
FROM ftx
""", visits=True)

_Z = ("km_per_month", "interval_km", "model_year", "visits_per_year", "revenue_per_year", "avg_items", "avg_gap_days")
sql("standardized_features", ACTIVITY + """,
st AS (SELECT """ + ", ".join(f"avg(x_{c}) AS m_{c}, stddev_pop(x_{c}) AS s_{c}" for c in _Z) + """ FROM ftx)
SELECT asset_id, """ + ", ".join(
    f"round(CASE WHEN s_{c} = 0 THEN 0.0 ELSE (x_{c} - m_{c}) / s_{c} END, 6) AS z_{c}" for c in _Z) + """
FROM ftx, st
""", visits=True)

sql("segment_profile", ACTIVITY + """
SELECT segment, count(DISTINCT asset_id) AS assets, round(avg(km_per_month), 6) AS avg_km_per_month,
       round(avg(visits_per_year), 6) AS avg_visits_per_year, round(avg(revenue_per_year), 6) AS avg_revenue_per_year,
       round(avg(avg_gap_days), 6) AS avg_gap_days, round(avg(anchor_visits), 6) AS avg_anchor_visits, segment AS top_segment
FROM ftx GROUP BY segment
""", visits=True)

sql("profile_given_labels", ACTIVITY + """,
gl AS (SELECT *, CAST(asset_id % 3 AS INTEGER) AS cluster_id FROM ftx),
gs AS (SELECT cluster_id, first(segment ORDER BY n DESC, segment DESC) AS top_segment
       FROM (SELECT cluster_id, segment, count(*) AS n FROM gl GROUP BY 1, 2) GROUP BY cluster_id)
SELECT cluster_id, count(DISTINCT asset_id) AS assets, round(avg(km_per_month), 6) AS avg_km_per_month,
       round(avg(visits_per_year), 6) AS avg_visits_per_year, round(avg(revenue_per_year), 6) AS avg_revenue_per_year,
       round(avg(avg_gap_days), 6) AS avg_gap_days, round(avg(anchor_visits), 6) AS avg_anchor_visits,
       any_value(top_segment) AS top_segment, 0.5::DOUBLE AS silhouette
FROM gl JOIN gs USING (cluster_id) GROUP BY cluster_id
""", visits=True)

sql("crosstab_given_labels", """,
gl AS (SELECT CAST(asset_id % 3 AS INTEGER) AS cluster_id, segment FROM assets),
gr AS (SELECT c.cluster_id, s.segment FROM (SELECT DISTINCT cluster_id FROM gl) c, (SELECT DISTINCT segment FROM gl) s)
SELECT cluster_id, segment, round(count(gl.segment) / CAST(sum(count(gl.segment)) OVER (PARTITION BY cluster_id) AS DOUBLE), 6) AS share
FROM gr LEFT JOIN gl USING (cluster_id, segment) GROUP BY cluster_id, segment
""")

sql("segment_counts_given_labels", """
SELECT segment, count(*) FILTER (WHERE asset_id % 3 = 0) AS "0", count(*) FILTER (WHERE asset_id % 3 = 1) AS "1",
       count(*) FILTER (WHERE asset_id % 3 = 2) AS "2" FROM assets GROUP BY segment
""")

sql("calendar_coverage", """,
dd AS (SELECT DISTINCT visit_date AS d FROM lines WHERE visit_date IS NOT NULL)
SELECT count(*) FILTER (WHERE d < DATE '1995-03-03') AS before_calendar,
       count(*) FILTER (WHERE d BETWEEN DATE '1995-03-03' AND DATE '2001-12-16') AS in_calendar,
       count(*) FILTER (WHERE d > DATE '2001-12-16') AS after_calendar FROM dd
""")

sql("training_frame", EPISODES + """
SELECT asset_id, visit_id, gap_days, gap_km, km_per_month, interval_km, car_age, fuel, drive, oil_type, segment
FROM ep WHERE gap_days IS NOT NULL AND km_per_month IS NOT NULL AND interval_km IS NOT NULL AND car_age IS NOT NULL
  AND gap_km IS NOT NULL AND fuel IS NOT NULL AND drive IS NOT NULL AND oil_type IS NOT NULL AND segment IS NOT NULL
""")

sql("interval_by_segment", EPISODES + """
SELECT segment, count(gap_days) AS n_episodes, avg(gap_days) AS avg_gap_days, CAST(median(gap_days) AS DOUBLE) AS median_gap_days,
       avg(gap_km) AS avg_gap_km, CAST(median(gap_km) AS DOUBLE) AS median_gap_km, round(avg(utilization), 6) AS avg_utilization
FROM ep WHERE segment IS NOT NULL GROUP BY segment
""")

sql("interval_sketch_by_segment", EPISODES + """,
b AS (SELECT segment, CAST(ceil(ln(gap_days) / ln(1.01 / 0.99)) AS INTEGER) AS bucket, count(*) AS n
      FROM ep WHERE segment IS NOT NULL GROUP BY ALL),
r AS (SELECT segment, 2 * pow(1.01 / 0.99, bucket) / (1.01 / 0.99 + 1) AS v,
             sum(n) OVER (PARTITION BY segment ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY segment) AS n FROM b),
q AS (SELECT segment, CAST(max(n) AS BIGINT) AS n, max(0.5::DOUBLE * (n - 1)) AS h5, max(0.9::DOUBLE * (n - 1)) AS h9,
             min(v) FILTER (upto > floor(0.5::DOUBLE * (n - 1))) AS l5, min(v) FILTER (upto > ceil(0.5::DOUBLE * (n - 1))) AS u5,
             min(v) FILTER (upto > floor(0.9::DOUBLE * (n - 1))) AS l9, min(v) FILTER (upto > ceil(0.9::DOUBLE * (n - 1))) AS u9
      FROM r GROUP BY segment),
x AS (SELECT segment, CAST(median(gap_days) AS DOUBLE) AS exact_median FROM ep GROUP BY segment)
SELECT q.segment, n, round(l5 + (h5 - floor(h5)) * (u5 - l5), 6) AS sketch_median,
       round(l9 + (h9 - floor(h9)) * (u9 - l9), 6) AS sketch_p90, exact_median, true AS within_bound
FROM q JOIN x USING (segment)
""")

sql("asset_history_bucketed", EPISODES + """,
v AS (SELECT visit_id, """ + FIRST_LINE.format(c="asset_id") + """ AS asset_id, min(visit_date) AS visit_date,
             sum(CAST(price AS DECIMAL(18,2))) AS revenue FROM lines WHERE visit_id IS NOT NULL GROUP BY visit_id),
pv AS (SELECT asset_id, count(*) AS n_visits, CAST(sum(revenue) AS DOUBLE) AS revenue, max(visit_date) AS last_visit
       FROM v WHERE asset_id IS NOT NULL GROUP BY asset_id),
pe AS (SELECT asset_id, count(*) AS n_episodes, CAST(sum(gap_days) AS BIGINT) AS gap_days FROM ep WHERE asset_id IS NOT NULL GROUP BY asset_id)
SELECT a.asset_id, a.segment, coalesce(n_visits, 0) AS n_visits, revenue, CAST(last_visit AS VARCHAR) AS last_visit,
       coalesce(n_episodes, 0) AS n_episodes, gap_days
FROM assets a LEFT JOIN pv USING (asset_id) LEFT JOIN pe USING (asset_id)
""")

SCORED = EPISODES + """,
tr AS (SELECT segment, regr_slope(log_gap_days, ln(km_per_month)) AS slope, regr_intercept(log_gap_days, ln(km_per_month)) AS icpt
       FROM ep GROUP BY segment),
sc AS (SELECT ep.*, least(greatest(exp(icpt + slope * ln(km_per_month)), 10.0), 500.0) AS pred_gap_days FROM ep JOIN tr USING (segment))"""

sql("scored_episodes", SCORED + """
SELECT asset_id, visit_id, segment, gap_days, round(pred_gap_days, 6) AS pred_gap_days FROM sc
""")

sql("interval_by_segment_scored", SCORED + """
SELECT segment, count(gap_days) AS n_episodes, avg(gap_days) AS avg_gap_days, CAST(median(gap_days) AS DOUBLE) AS median_gap_days,
       avg(gap_km) AS avg_gap_km, CAST(median(gap_km) AS DOUBLE) AS median_gap_km, round(avg(utilization), 6) AS avg_utilization,
       round(avg(pred_gap_days), 6) AS avg_pred_gap_days
FROM sc WHERE segment IS NOT NULL GROUP BY segment
""")

sql("alert_ranking_predicted", SCORED + ALERTS[len(EPISODES):].replace("median(gap_days) AS segment_interval FROM ep", "median(pred_gap_days) AS segment_interval FROM sc")
    .replace("(SELECT median(gap_days) FROM ep)", "(SELECT median(pred_gap_days) FROM sc)") + """
SELECT asset_id, segment, days_since_last_anchor, round(predicted_interval_days, 6) AS predicted_interval_days,
       round(progress_day, 6) AS progress_day, due_probability, priority_score, alert_tier FROM alerts
""")

AFT_GIVEN = EPISODES + """,
sc AS (SELECT ep.*, least(greatest(exp(4.1 - 0.0002 * km_per_month + 0.00005 * interval_km + 0.01 * car_age + 0.00001 * gap_km
                - CASE WHEN fuel = 'Diesel' THEN 0.05 ELSE 0 END + CASE WHEN segment = 'MACHINERY' THEN 0.1 ELSE 0 END)
                * power(ln(2.0), 1 / exp(1.2)), 10.0), 500.0) AS pred_gap_days
       FROM ep WHERE km_per_month IS NOT NULL AND interval_km IS NOT NULL AND car_age IS NOT NULL
         AND fuel IS NOT NULL AND drive IS NOT NULL AND oil_type IS NOT NULL AND segment IS NOT NULL)"""

sql("aft_given_coefficients", AFT_GIVEN + """
SELECT asset_id, visit_id, round(pred_gap_days, 6) AS pred_gap_days FROM sc
""")

sql("alert_ranking_aft_given", AFT_GIVEN + ALERTS[len(EPISODES):].replace("median(gap_days) AS segment_interval FROM ep", "median(pred_gap_days) AS segment_interval FROM sc")
    .replace("(SELECT median(gap_days) FROM ep)", "(SELECT median(pred_gap_days) FROM sc)") + """
SELECT t.alert_tier, coalesce(c.n, 0) AS assets
FROM (VALUES (0, 'Critical'), (1, 'High Priority'), (2, 'Warm Reminder'), (3, 'Monitor')) AS t(ord, alert_tier)
LEFT JOIN (SELECT alert_tier, count(*) AS n FROM alerts GROUP BY alert_tier) c USING (alert_tier)
""")

sql("log_gap_trend", EPISODES + """
SELECT segment, CAST(regr_count(log_gap_days, ln(km_per_month)) AS BIGINT) AS n,
       round(regr_slope(log_gap_days, ln(km_per_month)), 6) AS slope,
       round(regr_intercept(log_gap_days, ln(km_per_month)), 6) AS intercept,
       round(regr_r2(log_gap_days, ln(km_per_month)), 6) AS r2
FROM ep GROUP BY segment
""")

sql("uplift_scenarios", ALERTS + """,
tg AS (SELECT count(*) AS n FROM alerts WHERE alert_tier IN ('Warm Reminder', 'High Priority', 'Critical')),
aov AS (SELECT CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / CAST((SELECT count(DISTINCT visit_id) FROM lines WHERE visit_id IS NOT NULL) AS DOUBLE) AS v FROM lines),
sc AS (SELECT * FROM (VALUES ('Conservative', 0.08::DOUBLE, 0.03::DOUBLE), ('Base Case', 0.14::DOUBLE, 0.06::DOUBLE),
                             ('Aggressive', 0.22::DOUBLE, 0.10::DOUBLE)) AS t(scenario, assumed_conversion_rate, assumed_cross_sell_uplift)),
u AS (SELECT scenario, tg.n AS targetable_assets, assumed_conversion_rate, tg.n * assumed_conversion_rate AS incremental_visits,
             tg.n * assumed_conversion_rate * aov.v AS incremental_service_revenue, assumed_cross_sell_uplift
      FROM sc, tg, aov)
SELECT *, incremental_service_revenue * assumed_cross_sell_uplift AS incremental_cross_sell_revenue,
       incremental_service_revenue + incremental_service_revenue * assumed_cross_sell_uplift AS total_incremental_revenue
FROM u
""")

sql("topn_uplift", ALERTS + """,
tot AS (SELECT count(*) AS n, count(*) FILTER (WHERE alert_tier IN ('High Priority', 'Critical')) AS urgent FROM alerts),
av AS (SELECT CAST(sum(visit_revenue_d) AS DOUBLE) / count(*) AS v FROM visits WHERE has_anchor),
sc AS (SELECT * FROM (VALUES ('Top 100 due reminders', 100), ('Top 250 due reminders', 250), ('All High/Critical reminders', -1)) AS t(scenario, k)),
u AS (SELECT scenario, CASE WHEN k < 0 THEN tot.urgent ELSE least(CAST(k AS BIGINT), tot.n) END AS target_count, av.v FROM sc, tot, av)
SELECT scenario, target_count, 0.18::DOUBLE AS assumed_conversion, v AS avg_anchor_visit_value,
       target_count * 0.18::DOUBLE * v AS estimated_incremental_revenue FROM u
""", visits=True)

sql("next_best_offer", ALERTS + PAIRWISE + """,
tg AS (SELECT a.asset_id, a.customer_id, a.alert_tier, a.priority_score, la.last_anchor_visit_id AS visit_id
       FROM alerts a JOIN la USING (asset_id) WHERE a.alert_tier IN ('Warm Reminder', 'High Priority', 'Critical')),
bk AS (SELECT visit_id, list(DISTINCT item) AS items FROM lines WHERE visit_id IS NOT NULL AND item IS NOT NULL GROUP BY visit_id),
tb AS (SELECT tg.*, bk.items FROM tg JOIN bk USING (visit_id)),
cand AS (SELECT o.asset_id, r.antecedent, r.consequent, r.estimated_rule_revenue, r.lift, r.confidence
         FROM (SELECT asset_id, items, unnest(items) AS antecedent FROM tb) o JOIN rules r USING (antecedent)
         WHERE NOT list_contains(o.items, r.consequent)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY estimated_rule_revenue DESC, lift DESC,
                                                     confidence DESC, antecedent, consequent) AS rk FROM cand) WHERE rk = 1)
SELECT tb.asset_id, tb.customer_id, tb.alert_tier, tb.priority_score, tb.visit_id, best.antecedent AS offer_because_of,
       best.consequent AS next_best_offer, best.estimated_rule_revenue, best.lift, best.confidence
FROM tb LEFT JOIN best USING (asset_id)
""")

sql("campaign_target_list", ALERTS + CUSTOMERS + """
SELECT a.asset_id, a.customer_id, a.alert_tier, a.priority_score, v.value_score, v.value_segment, v.action
FROM alerts a LEFT JOIN vseg v USING (customer_id) WHERE a.alert_tier IN ('Warm Reminder', 'High Priority', 'Critical')
""", visits=True)

sql("capacity_schedule", WEEKLY + ALERTS + """,
hs AS (SELECT series, list(CAST(visits AS DOUBLE) ORDER BY week) AS h, max(week) AS last_week FROM dense GROUP BY series),
rec AS (
  SELECT series, 0 AS step, h, NULL::DOUBLE AS pred FROM hs
  UNION ALL
  SELECT series, step + 1, list_append(h, p), p
  FROM (SELECT *, greatest((h[-4] + h[-3] + h[-2] + h[-1]) / 4, 0.0) AS p FROM rec WHERE step < 8)),
fc AS (SELECT CAST(hs.last_week + 7 * r.step AS DATE) AS week, CAST(round_even(r.pred, 0) AS BIGINT) AS fv
       FROM rec r JOIN hs USING (series) WHERE r.step >= 1),
cp AS (SELECT *, (max(fv) OVER () * 11 + 9) // 10 AS cap FROM fc),
sl0 AS (SELECT week, sum(greatest(cap - fv, 0)) OVER (ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM cp),
sl AS (SELECT week, cum, coalesce(lag(cum) OVER (ORDER BY week), 0) AS prev FROM sl0),
tg AS (SELECT asset_id, customer_id, priority_score,
              CASE WHEN priority_score >= 85 THEN 'Critical' WHEN priority_score >= 70 THEN 'High Priority' ELSE 'Warm Reminder' END AS alert_tier,
              row_number() OVER (ORDER BY priority_score DESC NULLS LAST, coalesce(progress_km, -1.0) DESC, asset_id ASC) AS target_rank
       FROM b5 WHERE priority_score >= 55)
SELECT tg.asset_id, tg.customer_id, tg.alert_tier, round(tg.priority_score, 6) AS priority_score, tg.target_rank,
       CAST(sl.week AS VARCHAR) AS scheduled_week
FROM tg LEFT JOIN sl ON tg.target_rank > sl.prev AND tg.target_rank <= sl.cum
""")
SQL["capacity_schedule"] = SQL["capacity_schedule"].replace("WITH assets AS", "WITH RECURSIVE assets AS", 1)

sql("classify_item", """,
names AS (SELECT p_name AS name FROM part UNION SELECT item FROM lines)
SELECT name, CASE WHEN contains(name, 'Filter') THEN 'Oli & Filter'
                  WHEN contains(name, 'Tune') OR contains(name, 'Busi') THEN 'Tune Up'
                  WHEN contains(name, 'Rem') OR contains(name, 'Ban') OR contains(name, 'Spooring') THEN 'Rem & Kaki'
                  WHEN contains(name, 'Gardan') THEN 'Drivetrain'
                  WHEN contains(name, 'Coolant') OR contains(name, 'AC') THEN 'Pendingin'
                  WHEN contains(name, 'Aki') THEN 'Kelistrikan'
                  ELSE 'Lainnya' END AS category
FROM names
""")

sql("interval_rule", """,
b AS (SELECT asset_id, fuel, oil_type,
             CASE oil_type WHEN 'Mineral' THEN 4500 WHEN 'Semi-Sintetik' THEN 7000 WHEN 'Full-Sintetik' THEN 9500
                           WHEN 'Semi-Synthetic' THEN 7000 WHEN 'Full-Synthetic' THEN 9500 END AS base FROM assets)
SELECT asset_id, fuel, oil_type, CASE WHEN base IS NULL THEN NULL WHEN fuel = 'Diesel' THEN least(base, 6000)
                                      WHEN fuel = 'Hybrid' THEN greatest(base, 10000) ELSE base END AS rule_interval_km
FROM b
""")

sql("calendar_weight", """,
days AS (SELECT DISTINCT visit_date AS d FROM lines WHERE visit_date IS NOT NULL),
w AS (SELECT d, CASE isodow(d) WHEN 1 THEN 1.0 WHEN 2 THEN 1.0 WHEN 3 THEN 1.05 WHEN 4 THEN 1.05 WHEN 5 THEN 1.15
                               WHEN 6 THEN 1.45 WHEN 7 THEN 0.35 END::DOUBLE AS wd,
             CASE WHEN day(d) >= 25 OR day(d) <= 5 THEN 1.25::DOUBLE ELSE 1.0::DOUBLE END AS pay,
             (SELECT min(h - d) FROM (SELECT unnest([DATE '1995-03-03', DATE '1996-02-21', DATE '1997-02-09', DATE '1998-01-30', DATE '1999-01-19', DATE '2000-01-08', DATE '2000-12-27', DATE '2001-12-16']) AS h) WHERE h - d > 0 AND h - d <= 21) AS delta,
             list_contains([DATE '1995-01-01', DATE '1995-03-01', DATE '1995-03-02', DATE '1995-03-03', DATE '1995-03-04', DATE '1995-03-05', DATE '1995-03-06', DATE '1995-06-01', DATE '1995-08-17', DATE '1995-12-25', DATE '1996-01-01', DATE '1996-02-19', DATE '1996-02-20', DATE '1996-02-21', DATE '1996-02-22', DATE '1996-02-23', DATE '1996-02-24', DATE '1996-06-01', DATE '1996-08-17', DATE '1996-12-25', DATE '1997-01-01', DATE '1997-02-07', DATE '1997-02-08', DATE '1997-02-09', DATE '1997-02-10', DATE '1997-02-11', DATE '1997-02-12', DATE '1997-06-01', DATE '1997-08-17', DATE '1997-12-25', DATE '1998-01-01', DATE '1998-01-28', DATE '1998-01-29', DATE '1998-01-30', DATE '1998-01-31', DATE '1998-02-01', DATE '1998-02-02', DATE '1998-06-01', DATE '1998-08-17', DATE '1998-12-25', DATE '1999-01-01', DATE '1999-01-17', DATE '1999-01-18', DATE '1999-01-19', DATE '1999-01-20', DATE '1999-01-21', DATE '1999-01-22', DATE '1999-06-01', DATE '1999-08-17', DATE '1999-12-25', DATE '2000-01-01', DATE '2000-01-06', DATE '2000-01-07', DATE '2000-01-08', DATE '2000-01-09', DATE '2000-01-10', DATE '2000-01-11', DATE '2000-06-01', DATE '2000-08-17', DATE '2000-12-25', DATE '2000-12-26', DATE '2000-12-27', DATE '2000-12-28', DATE '2000-12-29', DATE '2000-12-30', DATE '2001-01-01', DATE '2001-06-01', DATE '2001-08-17', DATE '2001-12-14', DATE '2001-12-15', DATE '2001-12-16', DATE '2001-12-17', DATE '2001-12-18', DATE '2001-12-19', DATE '2001-12-25'], d) AS closed
      FROM days)
SELECT CAST(d AS VARCHAR) AS visit_date,
       CASE WHEN closed THEN 0.15::DOUBLE
            ELSE wd * pay * CASE WHEN delta IS NULL THEN 1.0::DOUBLE
                                 ELSE 1.0::DOUBLE + 0.9::DOUBLE * (1.0::DOUBLE - delta / 21.0::DOUBLE) END END AS weight
FROM w
""")

sql("clean_lines", """
SELECT line_id, CAST(visit_id AS VARCHAR) AS visit_id, CAST(asset_id AS VARCHAR) AS asset_id,
       CAST(visit_date AS VARCHAR) AS visit_date, CAST(meter_km AS DOUBLE) AS meter_km, branch, technician, category, item,
       CAST(qty AS BIGINT) AS qty, price, is_anchor
FROM lines
""")

sql("as_of_date", """
SELECT CAST(max(visit_date) AS VARCHAR) AS max_service_date, CAST(max(visit_date) + 1 AS VARCHAR) AS as_of FROM lines
""")

sql("executive_summary", (WEEKLY + EPISODES.replace(",\nal AS", ",\nal AS", 1) + PAIRWISE.replace(",\nntx AS", ",\nntx AS", 1)).replace("WITH assets", "WITH assets") + """,
hs AS (SELECT series, list(CAST(visits AS DOUBLE) ORDER BY week) AS h, sum(visits) AS tv, sum(revenue) AS tr FROM dense GROUP BY series),
rec AS (
  SELECT series, 0 AS step, h, NULL::DOUBLE AS pred FROM hs
  UNION ALL
  SELECT series, step + 1, list_append(h, p), p
  FROM (SELECT *, greatest((h[-4] + h[-3] + h[-2] + h[-1]) / 4, 0.0) AS p FROM rec WHERE step < 8)),
fc AS (SELECT CAST(round_even(r.pred, 0) AS BIGINT) AS fv,
              CAST(round_even(CAST(round_even(r.pred, 0) AS BIGINT) * (CAST(hs.tr AS DOUBLE) / greatest(CAST(hs.tv AS DOUBLE), 1.0)), 0) AS BIGINT) AS frev
       FROM rec r JOIN hs USING (series) WHERE r.step >= 1),
k AS (SELECT CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total,
             count(DISTINCT visit_id) AS visits FROM lines),
av AS (SELECT count(*) FILTER (WHERE a) AS anchor_visits FROM (SELECT visit_id, bool_or(is_anchor) AS a FROM lines WHERE visit_id IS NOT NULL GROUP BY visit_id)),
best AS (SELECT antecedent || ' → ' || consequent AS best_rule, estimated_rule_revenue AS best_rule_revenue FROM rules
         ORDER BY estimated_rule_revenue DESC, lift DESC, confidence DESC, antecedent, consequent LIMIT 1)
SELECT k.total AS total_revenue, k.total / CAST(k.visits AS DOUBLE) AS avg_order_value,
       CAST(av.anchor_visits AS DOUBLE) / CAST(k.visits AS DOUBLE) AS anchor_visit_share,
       (SELECT best_rule FROM best) AS best_rule, (SELECT best_rule_revenue FROM best) AS best_rule_revenue,
       (SELECT CAST(sum(fv) AS BIGINT) FROM fc) AS forecast_visits, (SELECT CAST(sum(frev) AS BIGINT) FROM fc) AS forecast_revenue,
       (SELECT count(*) FROM ep) AS episodes
FROM k, av
""")
SQL["executive_summary"] = SQL["executive_summary"].replace("WITH assets AS", "WITH RECURSIVE assets AS", 1)


def _long(name: str, section: str, item: str, values: list[str], tail: str = "", scale: str = "{}") -> str:
    """The result of another query's SQL as (section, item, metric, value)."""
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, CAST({item} AS VARCHAR) AS item, '{v}' AS metric, " + scale.format(f"CAST({v} AS DOUBLE)")
        + f" AS value FROM (SELECT * FROM ({SQL[name]}) {tail})" for v in values)


SQL["executive_tables"] = " UNION ALL ".join([
    f"SELECT 'kpi' AS section, 'all' AS item, metric, CAST(value AS DOUBLE) AS value FROM ({SQL['kpi_long']})",
    _long("interval_by_segment", "interval", "segment", ["n_episodes", "avg_gap_days", "avg_gap_km"]),
    _long("top_rules", "best_rule", "rule", ["confidence", "lift", "estimated_rule_revenue"],
          "ORDER BY estimated_rule_revenue DESC, lift DESC, confidence DESC, antecedent, consequent LIMIT 1"),
    _long("recursive_forecast_naive", "forecast", "week", ["forecast_visits", "forecast_anchor_visits", "forecast_revenue"]),
    _long("uplift_scenarios", "uplift", "scenario",
          ["targetable_assets", "incremental_visits", "incremental_service_revenue", "total_incremental_revenue"]),
])
SQL["chart_data"] = " UNION ALL ".join(
    _long(name, section, item, [value], scale="round({}, 6)") for name, section, item, value in (
        ("revenue_by_category", "revenue_by_category", "category", "revenue"),
        ("interval_by_segment", "interval_by_segment", "segment", "avg_gap_days"),
        ("top_rules", "top_rules", "rule", "estimated_rule_revenue"),
        ("recursive_forecast_naive", "weekly_forecast", "week", "forecast_visits"),
        ("tier_distribution", "alert_tiers", "alert_tier", "assets"),
        ("profile_given_labels", "profile", "cluster_id", "avg_revenue_per_year")))
