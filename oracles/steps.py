"""Reusable steps and calendar windows."""

from __future__ import annotations

from oracles.analysis import _CARDS, _PCARDS
from oracles.prelude import ADMITS, FILTERS, days, money, q, ratio, reason_text, span, status_text, whole

DAY = "2024-01-30"
MONTH = ("2024-01-01", "2024-01-30")
_SEEN = f"seen WHERE {days('dt', *MONTH)}"
SQL: dict[str, str] = {}

SQL["exposure_by_product_shop"] = q(f"SELECT prod_id, shop_id, count(*) AS expose, count(DISTINCT cid) AS expose_person_num FROM {_SEEN} GROUP BY 1, 2")
SQL["exposure_by_product"] = q(f"SELECT prod_id, count(*) AS expose, count(DISTINCT cid) AS expose_person_num FROM {_SEEN} GROUP BY 1")
SQL["exposure_visitors_by_shop"] = q(f"SELECT shop_id, count(DISTINCT cid) AS visitor FROM {_SEEN} GROUP BY 1")
SQL["share_visits_by_shop"] = q(f"SELECT shop_id, count(*) AS share_visit FROM {_SEEN} AND shared GROUP BY 1")
SQL["latest_product"] = q(f"{_CARDS} SELECT * FROM cards")
SQL["latest_product_by_product"] = q(f"{_PCARDS} SELECT * FROM cards")
# whole snapshot; the increment renames, revives deleted products, and adds new ids
SQL["merge_snapshot_increment"] = q(f"""
b AS (
  SELECT prod_id, shop_id, prod_name, price, supplier_price, status, pic, update_time, 1 AS src FROM prd WHERE status > -1
  UNION ALL SELECT prod_id, shop_id, 'new ' || prod_name, price, supplier_price, CASE status WHEN -1 THEN 1 ELSE status END, pic, update_time, 2
  FROM prd WHERE dt = DATE '{DAY}'
  UNION ALL SELECT prod_id + 10000000, shop_id, prod_name, price, supplier_price, status, pic, update_time, 2
  FROM prd WHERE status > -1 AND dt = DATE '{DAY}')
SELECT prod_id, shop_id, prod_name, price, supplier_price, status, pic FROM b
QUALIFY row_number() OVER (PARTITION BY prod_id ORDER BY src, update_time DESC, shop_id DESC, supplier_price DESC) = 1
""")
SQL["merge_snapshot_increment_shops"] = q("""
SELECT shop_id, shop_name FROM shp UNION ALL SELECT shop_id + 1000000, shop_name FROM shp
""")
SQL["one_name_per_shop"] = q("""
SELECT shop_id, CASE WHEN shop_id % 3 = 1 THEN 'A ' || shop_name ELSE shop_name END AS shop_name FROM shp
""")
SQL["latest_item_snapshot"] = q(f"""
SELECT DISTINCT i.prod_id, o.shop_id, i.prod_name AS item_name, i.price AS item_price, i.status AS item_status
FROM itmn i JOIN ord o ON o.order_number = i.order_number WHERE o.dt = DATE '{DAY}' AND i.dt = DATE '{DAY}'
""")
SQL["latest_status_today"] = q(f"SELECT DISTINCT prod_id, shop_id, status AS today_status FROM prd WHERE NOT is_deleted AND dt = DATE '{DAY}'")

_LINES = "ord o JOIN itm i ON i.order_number = o.order_number"
SQL["order_metrics_by_product"] = q(f"""
SELECT i.prod_id, o.shop_id, count(DISTINCT o.user_id) AS place_order_person, {whole('sum(i.prod_count)')} AS place_order_num,
       {money('sum(i.actual_total)')} AS place_order_amount
FROM {_LINES} WHERE {span('o.create_time', *MONTH)} GROUP BY 1, 2
""")
SQL["payment_metrics_by_product"] = q(f"""
SELECT i.prod_id, o.shop_id, count(DISTINCT o.user_id) AS pay_person, {whole('sum(i.prod_count)')} AS pay_num,
       {money('sum(i.actual_total)')} AS pay_amount
FROM {_LINES} WHERE o.is_paid AND {span('o.create_time', *MONTH)} AND {span('o.pay_time', *MONTH)} GROUP BY 1, 2
""")


def _trade(placed: str, paid: str) -> str:
    return f"""
SELECT i.prod_id, count(DISTINCT o.user_id) FILTER (WHERE {placed}) AS place_order_person,
       count(DISTINCT o.user_id) FILTER (WHERE {paid}) AS pay_person,
       {whole(f'sum(i.prod_count) FILTER (WHERE {placed})')} AS place_order_num,
       {whole(f'sum(i.prod_count) FILTER (WHERE {paid})')} AS pay_num,
       {money(f'sum(i.actual_total) FILTER (WHERE {placed})')} AS place_order_amount,
       {money(f'sum(i.actual_total) FILTER (WHERE {paid})')} AS pay_amount
FROM {_LINES}"""


SQL["payment_metrics_conditional"] = q(
    _trade("true", "o.is_paid") + f" WHERE {span('o.create_time', *MONTH)} GROUP BY 1"
)
_ON_DAY = span("o.create_time", DAY, DAY)
SQL["drop_all_zero"] = q(
    "z AS (" + _trade(_ON_DAY, f"o.is_paid AND {span('o.pay_time', DAY, DAY)}") + " GROUP BY 1)"
    " SELECT * FROM z WHERE place_order_person + pay_person + place_order_num + pay_num + place_order_amount + pay_amount > 0"
)

_APPLIED = span("r.apply_time", *MONTH)
_RL = f"""rl AS (
  SELECT i.prod_id, i.shop_id, r.refund_type, 2 AS via, r.refund_id, r.user_id, r.return_money_sts = 5 AS ok, i.actual_total, r.refund_amount
  FROM rfd r JOIN itm i ON i.order_item_id = r.order_item_id WHERE {_APPLIED}
  UNION ALL
  SELECT i.prod_id, i.shop_id, r.refund_type, 1, r.refund_id, r.user_id, r.return_money_sts = 5, i.actual_total, r.refund_amount
  FROM rfd r JOIN ord o ON o.order_id = r.order_id JOIN itm i ON i.order_number = o.order_number WHERE {_APPLIED})"""
SQL["refund_metrics_by_product"] = q(f"""{_RL}
SELECT prod_id, shop_id, count(DISTINCT refund_id) AS refund_num, count(DISTINCT user_id) AS refund_person,
       count(DISTINCT refund_id) FILTER (WHERE ok) AS refund_success_num,
       count(DISTINCT user_id) FILTER (WHERE ok) AS refund_success_person,
       {money('sum(refund_amount) FILTER (WHERE ok)')} AS refund_success_amount
FROM rl WHERE refund_type = via GROUP BY 1, 2
""")
SQL["refund_metrics_by_row"] = q(f"""{_RL}
SELECT prod_id, count(*) AS refund_num, count(DISTINCT user_id) AS refund_person, count(*) FILTER (WHERE ok) AS refund_success_num,
       count(DISTINCT user_id) FILTER (WHERE ok) AS refund_success_person,
       {money('sum(actual_total) FILTER (WHERE ok)')} AS refund_success_amount
FROM rl WHERE refund_type = via GROUP BY 1
""")
_TOUCHED = f"""SELECT i.prod_id FROM {_LINES} WHERE {span('o.create_time', *MONTH)} OR (o.is_paid AND {span('o.pay_time', *MONTH)})
UNION SELECT prod_id FROM rl"""
SQL["active_products"] = q(f"{_RL} {_TOUCHED} UNION SELECT prod_id FROM {_SEEN}")
SQL["active_products_without_exposure"] = q(f"{_RL} {_TOUCHED}")

SQL["dedup_exact_rows"] = q("SELECT order_item_id, order_number, prod_id, shop_id, prod_count, actual_total FROM itm")
SQL["dedup_by_sink_key"] = q("""
SELECT prod_id, shop_id, dt AS stat_date, max(prod_name) AS prod_name, max(supplier_price) AS supplier_price FROM prd GROUP BY 1, 2, 3
""")
SQL["status_fanout"] = q(f"""{_PCARDS}
SELECT prod_id, status, sf.status_filter FROM cards JOIN {FILTERS} ON {ADMITS.format(s='status')}
""")
SQL["shop_spine"] = q(f"""
SELECT shop_id, {whole('a')} AS big_orders, {whole('b')} AS refunds, {whole('c')} AS share_visit
FROM (SELECT shop_id, count(*) AS a FROM ord WHERE {span('create_time', DAY, DAY)} GROUP BY 1)
FULL JOIN (SELECT shop_id, count(*) AS b FROM rfd WHERE {span('refund_time', DAY, DAY)} GROUP BY 1) USING (shop_id)
FULL JOIN (SELECT shop_id, count(*) AS c FROM seen WHERE dt = DATE '{DAY}' AND shared GROUP BY 1) USING (shop_id)
""")
SQL["code_labels"] = q(f"""
SELECT 'status' AS kind, CAST(status AS VARCHAR) AS code, {status_text('status')} AS label, count(*) AS row_count FROM prd GROUP BY ALL
UNION ALL
SELECT 'reason', buyer_reason, {reason_text('buyer_reason')}, count(*) FROM rfd GROUP BY ALL
""")
SQL["safe_rate"] = q(f"""
t AS (
  SELECT shop_id, count(*) AS n, count(*) FILTER (WHERE is_paid) AS paid, sum(actual_total) AS amount,
         count(*) FILTER (WHERE is_paid AND {span('pay_time', DAY, DAY)} AND user_id % 7 = 0) AS few
  FROM ord GROUP BY 1)
SELECT shop_id, {ratio('paid', 'n', 2, 100)} AS paid_percent, {ratio('n', 'few', 1, 100)} AS orders_per_few_percent,
       {ratio('few', 'paid', 4)} AS few_ratio, {ratio('amount', 'paid', 2)} AS amount_per_paid
FROM t
""")

# windows per key: start, end, start is open, tag, time type, first day, last day, stat date
_WINDOWS = {
    "trailing_window": [
        ("2024-01-24 00:00:00", "2024-01-30 23:59:59", False, "7", 0, "2024-01-31"),
        ("2024-01-01 00:00:00", "2024-01-30 23:59:59", False, "30", 0, "2024-01-31"),
    ],
    "month_window": [
        ("2024-01-01 00:00:00", "2024-01-30 23:59:59", False, "202401", 0, "2024-01-30"),
        ("2024-01-01 00:00:00", "2024-01-31 23:59:59", False, "202401", 0, "2024-01-31"),
        ("2024-01-01 00:00:00", "2024-01-11 23:59:59", False, "202401", 0, "2024-01-11"),
    ],
    "period_to_date": [
        ("2024-01-30 00:00:00", "2024-01-30 23:59:59", False, "20240130", 1, "2024-01-30"),
        ("2024-01-29 00:00:00", "2024-01-30 23:59:59", False, "202405", 2, "2024-01-30"),
        ("2024-01-01 00:00:00", "2024-01-30 23:59:59", False, "202401", 3, "2024-01-30"),
    ],
    "intraday_window": [
        ("2024-01-29 00:00:00", "2024-01-29 23:59:59", False, "2024-01-29", 0, "2024-01-29"),
        ("2024-01-30 00:00:00", "2024-01-30 13:15:30", False, "2024-01-30", 0, "2024-01-30"),
    ],
    "month_back_window": [
        ("2024-01-15 23:59:59", "2024-02-15 23:59:59", True, "2024-02-15", 0, "2024-02-15"),
        ("2023-12-30 23:59:59", "2024-01-30 23:59:59", True, "2024-01-30", 0, "2024-01-30"),
    ],
    "single_day": [("2024-01-30 00:00:00", "2024-01-30 23:59:59", False, "2024-01-30", 0, "2024-01-30")],
    "like_day": [("2024-01-29 00:00:00", "2024-01-29 23:59:59", False, "2024-01-29", 0, "2024-01-29")],
}


def _window(start: str, end: str, is_open: bool, tag: str, time_type: int, stat: str) -> str:
    return f"""SELECT shop_id, count(*) AS pay_order_count, {money('sum(actual_total)')} AS pay_actual_total,
  '{tag}' AS period_tag, {time_type} AS time_type, DATE '{start[:10]}' AS first_day, DATE '{end[:10]}' AS last_day,
  DATE '{stat}' AS stat_date
FROM ord WHERE is_paid AND pay_time {'>' if is_open else '>='} TIMESTAMP '{start}' AND pay_time <= TIMESTAMP '{end}' GROUP BY shop_id"""


for _name, _rows in _WINDOWS.items():
    SQL[_name] = q(" UNION ALL ".join(_window(*r) for r in _rows))
