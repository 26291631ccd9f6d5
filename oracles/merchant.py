"""Shop-level reports."""

from __future__ import annotations

from oracles.prelude import money, q, ratio, reason_text, span, whole

DAY, PREV = "2024-01-30", "2024-01-29"
SQL: dict[str, str] = {}

SQL["merchant_paid_yesterday"] = q(f"""
SELECT shop_id, {money('sum(actual_total)')} AS "payActualTotal", count(DISTINCT user_id) AS "payUserCount",
       count(*) AS "payOrderCount", {ratio('sum(actual_total)', 'count(DISTINCT user_id)', 6)} AS "onePrice"
FROM ord WHERE is_paid AND dt = DATE '{DAY}' AND CAST(pay_time AS DATE) = DATE '{DAY}' GROUP BY shop_id
""")

SQL["merchant_hourly_gmv"] = q(f"""
SELECT CAST(pay_time AS DATE) AS order_date, strftime(pay_time, '%H') AS hour_of_day, shop_id,
       count(*) AS order_count, {money('sum(actual_total)')} AS pay_actual_total, DATE '{DAY}' AS stat_date
FROM ord WHERE is_paid AND dt = DATE '{DAY}' AND {span('pay_time', DAY, DAY)} GROUP BY 1, 2, 3
""")
SQL["hourly_gmv_stream"] = SQL["merchant_hourly_gmv"]

SQL["merchant_daily_order_pay"] = q(f"""
pay AS (
  SELECT shop_id, CAST(pay_time AS DATE) AS d, sum(actual_total) AS amount, count(DISTINCT user_id) AS users, count(*) AS n
  FROM ord WHERE is_paid GROUP BY 1, 2),
back AS (SELECT shop_id, CAST(refund_time AS DATE) AS d, sum(refund_amount) AS amount FROM rfd WHERE return_money_sts = 5 GROUP BY 1, 2),
spine AS (
  SELECT shop_id FROM pay WHERE d IN (DATE '{DAY}', DATE '{PREV}')
  UNION SELECT shop_id FROM back WHERE d IN (DATE '{DAY}', DATE '{PREV}'))
SELECT s.shop_id, {money('a.amount')} AS pay_actual_total, {whole('a.users')} AS pay_user_count,
       {whole('a.n')} AS pay_order_count, {ratio('a.amount', 'a.users', 6)} AS one_price, {money('r.amount')} AS refund,
       {money('b.amount')} AS yesterday_pay_actual_total, {whole('b.users')} AS yesterday_pay_user_count,
       {whole('b.n')} AS yesterday_pay_order_count, {ratio('b.amount', 'b.users', 6)} AS yesterday_one_price,
       {money('rb.amount')} AS yesterday_refund, DATE '{DAY}' AS stat_date
FROM spine s
LEFT JOIN pay a ON a.shop_id = s.shop_id AND a.d = DATE '{DAY}'
LEFT JOIN pay b ON b.shop_id = s.shop_id AND b.d = DATE '{PREV}'
LEFT JOIN back r ON r.shop_id = s.shop_id AND r.d = DATE '{DAY}'
LEFT JOIN back rb ON rb.shop_id = s.shop_id AND rb.d = DATE '{PREV}'
""")

SQL["merchant_order_pay_agg"] = q(f"""
m AS (SELECT shop_id, {money('sum(actual_total)')} AS total FROM ord WHERE is_paid AND {span('pay_time', '2024-01-01', DAY)} GROUP BY 1)
SELECT o.shop_id, count(*) AS pay_order_count, {money('sum(actual_total)')} AS pay_actual_total,
       {money('sum(actual_total)')} AS today_amount, {money('sum(actual_total)')} AS month_amount,
       any_value(m.total) AS month_to_date_amount, DATE '{DAY}' AS stat_date
FROM ord o JOIN m ON m.shop_id = o.shop_id WHERE is_paid AND {span('pay_time', DAY, DAY)} GROUP BY o.shop_id
""")

SQL["merchant_refund_stats"] = q(f"""
r AS (SELECT shop_id, sum(refund_amount) AS amount, count(DISTINCT order_id) AS n FROM rfd
      WHERE return_money_sts = 5 AND {span('refund_time', DAY, DAY)} GROUP BY 1),
o AS (SELECT shop_id, count(order_id) AS n FROM ord WHERE status >= 2 AND {span('pay_time', DAY, DAY)} GROUP BY 1)
SELECT DATE '{DAY}' AS refund_date, '{DAY}' AS refund_date_to_string, shop_id, {money('r.amount')} AS pay_actual_total,
       {whole('r.n')} AS refund_count, {whole('o.n')} AS pay_order_count,
       CASE WHEN coalesce(r.n, 0) > 0 AND coalesce(o.n, 0) = 0 THEN CAST(100 AS DECIMAL(18,4))
            ELSE {ratio('r.n', 'o.n', 4, 100)} END AS refund_rate, DATE '{DAY}' AS stat_date
FROM r FULL JOIN o USING (shop_id)
""")

# refunds that succeeded after the end of the same day last month and up to the end of today
_RECENT = "return_money_sts = 5 AND refund_time > TIMESTAMP '2023-12-30 23:59:59' AND refund_time <= TIMESTAMP '2024-01-30 23:59:59'"

SQL["refund_product_rank"] = q(f"""
back AS (SELECT DISTINCT order_item_id, order_id, refund_type, refund_time, goods_num FROM rfd WHERE {_RECENT}),
hit AS (
  SELECT DISTINCT order_item_id, prod_id, order_number, prod_count, prod_name FROM itmn i
  WHERE EXISTS (SELECT 1 FROM back b WHERE b.refund_type = 2 AND b.order_item_id = i.order_item_id)
     OR EXISTS (SELECT 1 FROM back b JOIN ord o ON o.order_id = b.order_id
                WHERE b.refund_type = 1 AND o.order_number = i.order_number)),
n AS (
  SELECT prod_id, {whole('sum(coalesce(b.goods_num, h.prod_count))')} AS refund_count, max(prod_name) AS refund_prod_name
  FROM hit h LEFT JOIN back b ON b.order_item_id = h.order_item_id GROUP BY prod_id),
c AS (SELECT prod_id, shop_id, max(pic) AS pic FROM prd GROUP BY 1, 2)
SELECT c.prod_id, c.shop_id, refund_count, refund_prod_name, pic, DATE '{DAY}' AS stat_date
FROM c JOIN n ON n.prod_id = c.prod_id WHERE refund_count > 0
""")

SQL["refund_reason_rank"] = q(f"""
back AS (SELECT * FROM rfd WHERE {_RECENT}),
oname AS (SELECT o.order_id, CASE WHEN o.order_id % 2 = 0 THEN max(i.prod_name) END AS nm
          FROM ord o JOIN itmn i ON i.order_number = o.order_number GROUP BY o.order_id),
icard AS (SELECT order_item_id, max(prod_name) AS nm, max(prod_id) AS prod_id FROM itmn GROUP BY 1),
pics AS (SELECT prod_id, max(pic) AS pic FROM prd GROUP BY 1),
d AS (
  SELECT b.shop_id, b.refund_amount, {reason_text('b.buyer_reason')} AS buyer_reason,
         coalesce(oname.nm, icard.nm, '未知商品') AS nm, pics.pic
  FROM back b LEFT JOIN oname ON oname.order_id = b.order_id
  LEFT JOIN icard ON icard.order_item_id = b.order_item_id LEFT JOIN pics ON pics.prod_id = icard.prod_id),
tot AS (SELECT shop_id, sum(refund_amount) AS total FROM back GROUP BY 1)
SELECT buyer_reason, max(nm) AS refund_prod_name, count(*) AS refund_count, {money('sum(refund_amount)')} AS pay_actual_total,
       {ratio('sum(refund_amount)', 'max(total)', 1, 100)} AS percent_amount, max(pic) AS pic, d.shop_id, DATE '{DAY}' AS stat_date
FROM d JOIN tot ON tot.shop_id = d.shop_id GROUP BY buyer_reason, d.shop_id
""")

_PERIODS = {
    "day": ("2024-01-30", "20240130", 1), "week": ("2024-01-29", "202405", 2), "month": ("2024-01-01", "202401", 3),
}


def _comprehensive(first: str, tag: str, time_type: int) -> str:
    win = f"TIMESTAMP '{first} 00:00:00' AND TIMESTAMP '{DAY} 23:59:59'"
    return f"""
SELECT shop_id, {ratio('pa', 'pu', 2)} AS customer_unit_price, {money('pa')} AS total_transaction_amount,
       {money('oa')} AS order_amount, {whole('ou')} AS user_nums, {whole('oc')} AS order_nums, {whole('op')} AS product_nums,
       {money('pa')} AS pay_amount, {whole('pu')} AS pay_user_nums, {whole('pc')} AS pay_order_nums,
       {whole('pp')} AS pay_product_nums, {money('ra')} AS refund_amount, {whole('rc')} AS refund_order_nums,
       {ratio('pc', 'oc', 2, 100)} AS order_to_pay_rate, {ratio('rc', 'pc', 2, 100)} AS refund_rate,
       DATE '{DAY}' AS stat_date, '{tag}' AS date_time, {time_type} AS time_type
FROM (SELECT shop_id, sum(actual_total) AS oa, count(DISTINCT user_id) AS ou, count(*) AS oc FROM ord
      WHERE create_time BETWEEN {win} GROUP BY 1)
FULL JOIN (SELECT o.shop_id, sum(i.prod_count) AS op, sum(i.prod_count) FILTER (WHERE o.is_paid) AS pp
      FROM ord o JOIN itm i ON i.order_number = o.order_number WHERE o.create_time BETWEEN {win} GROUP BY 1) USING (shop_id)
FULL JOIN (SELECT shop_id, sum(actual_total) AS pa, count(DISTINCT user_id) AS pu, count(*) AS pc FROM ord
      WHERE is_paid AND create_time BETWEEN {win} GROUP BY 1) USING (shop_id)
FULL JOIN (SELECT shop_id, sum(refund_amount) AS ra, count(DISTINCT order_id) AS rc FROM rfd
      WHERE return_money_sts = 5 AND refund_time BETWEEN {win} GROUP BY 1) USING (shop_id)
"""


for _name, _args in _PERIODS.items():
    SQL[f"merchant_comprehensive_{_name}"] = q(_comprehensive(*_args))
SQL["merchant_comprehensive_all"] = q(" UNION ALL ".join(_comprehensive(*a) for a in _PERIODS.values()))
