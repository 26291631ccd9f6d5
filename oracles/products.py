"""Product overviews, sales ranking, visitor conversion."""

from __future__ import annotations

from oracles.prelude import SPANS, days, money, q, ratio, span, whole

DAY = "2024-01-30"
SQL: dict[str, str] = {}


def _period(first: str, last: str, tag: str, stat: str) -> str:
    return f"""
SELECT shop_id, {whole('n')} AS order_num, {whole('pn')} AS pay_num, {whole('ds')} AS dynamic_sale, {whole('np')} AS new_prod,
       {whole('vp')} AS visited_prod, {whole('ex')} AS expose, {whole('ex')} AS browse, {whole('vis')} AS visitor,
       '{tag}' AS time_period, DATE '{stat}' AS stat_date
FROM (SELECT shop_id, count(prod_id) AS np FROM prd WHERE status <> -1 AND {span('create_time', first, last)} GROUP BY 1)
FULL JOIN (SELECT o.shop_id, sum(i.prod_count) AS n, sum(i.prod_count) FILTER (WHERE o.is_paid) AS pn,
             count(DISTINCT i.prod_id) AS ds
      FROM ord o LEFT JOIN itm i ON i.order_number = o.order_number WHERE {span('o.create_time', first, last)} GROUP BY 1) USING (shop_id)
FULL JOIN (SELECT shop_id, count(DISTINCT prod_id) AS vp, count(*) AS ex, count(DISTINCT cid) AS vis FROM seen
      WHERE {days('dt', first, last)} GROUP BY 1) USING (shop_id)
"""


def _rank(first: str, last: str, tag: str, stat: str) -> str:
    return f"""
SELECT c.prod_id, c.shop_id, s.shop_name, c.pic, c.prod_name, {money('v.amount')} AS pay_amount, {whole('v.n')} AS pay_count,
       row_number() OVER (PARTITION BY c.shop_id ORDER BY v.amount DESC, c.prod_id) AS rank_num,
       '{tag}' AS time_period, DATE '{stat}' AS stat_date
FROM (SELECT DISTINCT prod_id, shop_id, prod_name, pic FROM prd WHERE status <> -1) c
JOIN (SELECT i.prod_id, sum(i.actual_total) AS amount, sum(i.prod_count) AS n
      FROM itm i JOIN ord o ON o.order_number = i.order_number
      WHERE o.is_paid AND {span('o.pay_time', first, last)} GROUP BY 1) v ON v.prod_id = c.prod_id
LEFT JOIN shp s ON s.shop_id = c.shop_id
"""


def _conversion(first: str, last: str, tag: str, stat: str) -> str:
    return f"""
SELECT prod_id, shop_id, shop_name, prod_name, pic, {whole('vis')} AS visitor_num,
       {ratio('users', 'vis', 4)} AS visitor_to_pay_rate, {whole('users')} AS pay_user_count,
       row_number() OVER (PARTITION BY shop_id ORDER BY coalesce(vis, 0) DESC, prod_id) AS rank_num,
       '{tag}' AS time_period, DATE '{stat}' AS stat_date
FROM (SELECT DISTINCT prod_id, shop_id, prod_name, pic FROM prd WHERE status <> -1)
LEFT JOIN (SELECT prod_id, shop_id, count(DISTINCT cid) AS vis FROM seen WHERE {days('dt', first, last)} GROUP BY 1, 2)
  USING (prod_id, shop_id)
LEFT JOIN (SELECT i.prod_id, o.shop_id, count(DISTINCT i.user_id) AS users FROM itm i
           JOIN ord o ON o.order_number = i.order_number WHERE {span('i.rec_time', first, last)} GROUP BY 1, 2)
  USING (prod_id, shop_id)
LEFT JOIN shp USING (shop_id)
WHERE coalesce(vis, 0) > 0 OR coalesce(users, 0) > 0
"""


for _key, _build in (
    ("product_overview_period", _period), ("product_sales_rank", _rank), ("product_visitor_conversion", _conversion),
):
    for _name, _args in SPANS.items():
        SQL[f"{_key}_{_name}"] = q(_build(*_args))
    SQL[f"{_key}_all"] = q(" UNION ALL ".join(_build(*a) for a in SPANS.values()))


def _daily(where: str, log_where: str, live: str = "true") -> str:
    return f"""
o AS (
  SELECT o.shop_id, CAST(o.create_time AS DATE) AS d, sum(i.prod_count) AS n,
         sum(i.prod_count) FILTER (WHERE o.is_paid) AS pn, count(DISTINCT i.prod_id) AS ds
  FROM ord o LEFT JOIN itm i ON i.order_number = o.order_number WHERE {where.format(t='o.create_time')} GROUP BY 1, 2),
p AS (SELECT shop_id, CAST(create_time AS DATE) AS d, count(prod_id) AS np FROM prd
      WHERE status <> -1 AND {live} AND {where.format(t='create_time')} GROUP BY 1, 2),
e AS (SELECT shop_id, dt AS d, count(DISTINCT prod_id) AS vp, count(*) AS ex, count(DISTINCT cid) AS vis,
             count(*) FILTER (WHERE shared) AS sv FROM seen WHERE {log_where} GROUP BY 1, 2)
SELECT shop_id, d AS current_day, {whole('np')} AS new_prod, {whole('vp')} AS visited_prod, {whole('ds')} AS dynamic_sale,
       {whole('ex')} AS expose, {whole('ex')} AS browse, {whole('vis')} AS visitor, 0 AS add_cart,
       {whole('n')} AS order_num, {whole('pn')} AS pay_num, {whole('sv')} AS share_visit
FROM o FULL JOIN p USING (shop_id, d) LEFT JOIN e USING (shop_id, d)
"""


SQL["product_overview_daily"] = q(_daily(f"CAST({{t}} AS DATE) = DATE '{DAY}'", f"dt = DATE '{DAY}'"))
SQL["product_overview_daily_intraday"] = q(_daily(f"CAST({{t}} AS DATE) = DATE '{DAY}'", f"dt = DATE '{DAY}'", "NOT is_deleted"))
SQL["product_overview_backfill"] = q(
    _daily("CAST({t} AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'", "dt BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'")
)



def _every_event(sql: str) -> str:
    """The SQL over a log that leaves no event out: all are screen views of the product page."""
    for part, whole_part in (
        ("event_id % 7 <> 0 AS on_page, event_id % 3 = 0 AND event_id % 5 <> 0 AS shared", "event_id % 3 = 0 AS shared"),
        ("WHERE action = 'enter' AND on_page)", "WHERE action = 'enter')"),
    ):
        assert part in sql
        sql = sql.replace(part, whole_part)
    return sql


# the raw report keeps the log of several pages
SQL["raw_product_overview_period_all"] = SQL["product_overview_period_all"]
for _name in ("product_overview_period_7", "product_overview_period_all", "product_overview_daily", "product_overview_backfill"):
    SQL[_name] = _every_event(SQL[_name])

SQL["app_log_label_expand"] = f"""
SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS prod_id, event_id % 10 AS shop_id, CAST(user_id AS VARCHAR) AS cid,
       CASE WHEN event_type = 'view' THEN 'enter' ELSE event_type END AS action, '1005' AS page_id,
       CASE WHEN event_id % 5 = 0 THEN 'AppClick' ELSE 'AppViewScreen' END AS event,
       CAST(ts AS DATE) AS dt, CASE WHEN event_id % 3 = 0 THEN '1' ELSE '0' END AS "isShare"
FROM events WHERE CAST(ts AS DATE) = DATE '{DAY}' AND event_id % 7 <> 0
"""
SQL["app_log_label_expand_inferred"] = SQL["app_log_label_expand"]
