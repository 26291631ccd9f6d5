"""Product analyses, per merchant and for the platform."""

from __future__ import annotations

from oracles.prelude import ADMITS, FILTERS, SPANS, days, money, q, ratio, span, status_text, whole

DAY = "2024-01-30"
SQL: dict[str, str] = {}

_CARD_ORDER = "update_time DESC, supplier_price DESC, status DESC, price DESC, prod_name DESC, shop_id DESC, pic DESC"


def _measures(price: str = "price", status: str = "status") -> str:
    return f"""{price} AS price, supplier_price, {whole('ex')} AS expose, {whole('exp')} AS expose_person_num,
  0 AS add_cart_person, 0 AS add_cart, {whole('ou')} AS place_order_person, {whole('pu')} AS pay_person,
  {whole('oc')} AS place_order_num, {whole('pc')} AS pay_num, {money('oa')} AS place_order_amount, {money('pa')} AS pay_amount,
  {ratio('pu', 'exp', 2, 100)} AS single_prod_rate, {whole('rn')} AS refund_num, {whole('rp')} AS refund_person,
  {whole('sn')} AS refund_success_num, {whole('sp')} AS refund_success_person, {money('sa')} AS refund_success_amount,
  {ratio('sn', 'rn', 2, 100)} AS refund_success_rate, {status} AS status, {status_text(status)} AS prod_status, sf.status_filter"""


_REFUND_COUNTS = """count(DISTINCT refund_id) AS rn, count(DISTINCT user_id) AS rp,
  count(DISTINCT refund_id) FILTER (WHERE ok) AS sn, count(DISTINCT user_id) FILTER (WHERE ok) AS sp,
  sum(amount) FILTER (WHERE ok) AS sa"""

_ANY = "(coalesce(ex, 0) > 0 OR coalesce(ou, 0) > 0 OR coalesce(pu, 0) > 0 OR coalesce(rn, 0) > 0)"


def _merchant(n: int, first: str, last: str, tag: str, stat: str) -> tuple[str, str]:
    created = span("o.create_time", first, last)
    applied = span("r.apply_time", first, last)
    ctes = f"""
e{n} AS (SELECT prod_id, shop_id, count(*) AS ex, count(DISTINCT cid) AS exp FROM seen WHERE {days('dt', first, last)} GROUP BY 1, 2),
o{n} AS (
  SELECT i.prod_id, o.shop_id, count(DISTINCT o.user_id) AS ou, sum(i.prod_count) AS oc, sum(i.actual_total) AS oa
  FROM ord o JOIN itm i ON i.order_number = o.order_number WHERE {created} GROUP BY 1, 2),
p{n} AS (
  SELECT i.prod_id, o.shop_id, count(DISTINCT o.user_id) AS pu, sum(i.prod_count) AS pc, sum(i.actual_total) AS pa
  FROM ord o JOIN itm i ON i.order_number = o.order_number
  WHERE o.is_paid AND {created} AND {span('o.pay_time', first, last)} GROUP BY 1, 2),
r{n} AS (
  SELECT prod_id, shop_id, {_REFUND_COUNTS} FROM (
    SELECT DISTINCT i.prod_id, i.shop_id, r.refund_id, r.user_id, r.return_money_sts = 5 AS ok, r.refund_amount AS amount, 2 AS kind
    FROM rfd r JOIN itm i ON i.order_item_id = r.order_item_id WHERE r.refund_type = 2 AND {applied}
    UNION ALL
    SELECT DISTINCT i.prod_id, i.shop_id, r.refund_id, r.user_id, r.return_money_sts = 5, r.refund_amount, 1
    FROM rfd r JOIN ord o ON o.order_id = r.order_id JOIN itm i ON i.order_number = o.order_number
    WHERE r.refund_type = 1 AND {applied} AND {created})
  GROUP BY 1, 2)"""
    body = f"""
SELECT prod_id, shop_id, {_measures()}, DATE '{stat}' AS stat_date, coalesce(prod_name, '') AS prod_name,
       coalesce(pic, '') AS prod_url, coalesce(shop_name, '') AS shop_name, '{tag}' AS time_period
FROM cards LEFT JOIN e{n} USING (prod_id, shop_id) LEFT JOIN o{n} USING (prod_id, shop_id)
LEFT JOIN p{n} USING (prod_id, shop_id) LEFT JOIN r{n} USING (prod_id, shop_id) LEFT JOIN shp USING (shop_id)
JOIN {FILTERS} ON {ADMITS.format(s='status')}
WHERE {_ANY}"""
    return ctes, body


_CARDS = f"""cards AS (
  SELECT prod_id, shop_id, prod_name, price, supplier_price, status, pic FROM prd
  QUALIFY row_number() OVER (PARTITION BY prod_id, shop_id ORDER BY {_CARD_ORDER}) = 1)"""

_PCARDS = f"""cards AS (
  SELECT prod_id, shop_id, prod_name, price, supplier_price, status, pic FROM prd
  QUALIFY row_number() OVER (PARTITION BY prod_id
    ORDER BY update_time DESC, shop_id DESC, prod_name DESC, price DESC, supplier_price DESC, status DESC, pic DESC) = 1)"""


def _platform(n: int, first: str, last: str, tag: str, stat: str) -> tuple[str, str]:
    created, paid = span("o.create_time", first, last), span("o.pay_time", first, last)
    applied = span("r.apply_time", first, last)
    ctes = f"""
e{n} AS (SELECT prod_id, shop_id, count(*) AS ex, count(DISTINCT cid) AS exp FROM seen WHERE {days('dt', first, last)} GROUP BY 1, 2),
o{n} AS (
  SELECT i.prod_id, count(DISTINCT o.user_id) AS ou, count(DISTINCT o.user_id) FILTER (WHERE o.is_paid) AS pu,
         sum(i.prod_count) AS oc, sum(i.prod_count) FILTER (WHERE o.is_paid) AS pc,
         sum(i.actual_total) AS oa, sum(i.actual_total) FILTER (WHERE o.is_paid) AS pa
  FROM ord o JOIN itm i ON i.order_number = o.order_number WHERE {created} GROUP BY 1),
rl{n} AS (
  SELECT i.prod_id, r.refund_type, 2 AS via, r.user_id, r.return_money_sts = 5 AS ok, i.actual_total AS amount
  FROM rfd r JOIN itm i ON i.order_item_id = r.order_item_id WHERE {applied}
  UNION ALL
  SELECT i.prod_id, r.refund_type, 1, r.user_id, r.return_money_sts = 5, i.actual_total
  FROM rfd r JOIN ord o ON o.order_id = r.order_id JOIN itm i ON i.order_number = o.order_number WHERE {applied}),
r{n} AS (
  SELECT prod_id, count(*) AS rn, count(DISTINCT user_id) AS rp, count(*) FILTER (WHERE ok) AS sn,
         count(DISTINCT user_id) FILTER (WHERE ok) AS sp, sum(amount) FILTER (WHERE ok) AS sa
  FROM rl{n} WHERE refund_type = via GROUP BY 1),
act{n} AS (
  SELECT prod_id FROM e{n} UNION SELECT prod_id FROM o{n} UNION SELECT prod_id FROM rl{n}
  UNION SELECT i.prod_id FROM itm i JOIN ord o ON o.order_number = i.order_number WHERE o.is_paid AND {paid})"""
    body = f"""
SELECT 0 AS id, prod_id, {_measures()}, DATE '{stat}' AS stat_date, prod_name, coalesce(pic, '') AS prod_url,
       coalesce(shop_name, '') AS shop_name, '{tag}' AS time_period
FROM cards JOIN act{n} USING (prod_id) LEFT JOIN e{n} USING (prod_id, shop_id) LEFT JOIN o{n} USING (prod_id)
LEFT JOIN r{n} USING (prod_id) LEFT JOIN shp USING (shop_id) JOIN {FILTERS} ON {ADMITS.format(s='status')}"""
    return ctes, body


for _key, _cards, _build in (
    ("merchant_product_analysis", _CARDS, _merchant), ("platform_product_analysis", _PCARDS, _platform),
):
    _parts = {name: _build(i, *args) for i, (name, args) in enumerate(SPANS.items())}
    for _name, (_ctes, _body) in _parts.items():
        SQL[f"{_key}_{_name}"] = q(f"{_cards},{_ctes}{_body}")
    SQL[f"{_key}_all"] = q(
        _cards + "," + ",".join(c for c, _ in _parts.values()) + " UNION ALL ".join(b for _, b in _parts.values())
    )

_ON = f"= DATE '{DAY}'"

SQL["merchant_product_analysis_today"] = q(f"""{_CARDS},
od AS (SELECT * FROM ord WHERE dt {_ON}), id AS (SELECT * FROM itmn WHERE dt {_ON}),
rd AS (SELECT * FROM rfd WHERE dt {_ON} AND CAST(apply_time AS DATE) {_ON}),
e AS (SELECT prod_id, shop_id, count(*) AS ex, count(DISTINCT cid) AS exp FROM seen WHERE dt {_ON} GROUP BY 1, 2),
o AS (SELECT i.prod_id, o.shop_id, count(DISTINCT o.user_id) AS ou, sum(i.prod_count) AS oc, sum(i.actual_total) AS oa
      FROM od o JOIN id i ON i.order_number = o.order_number WHERE CAST(o.create_time AS DATE) {_ON} GROUP BY 1, 2),
p AS (SELECT i.prod_id, o.shop_id, count(DISTINCT o.user_id) AS pu, sum(i.prod_count) AS pc, sum(i.actual_total) AS pa
      FROM od o JOIN id i ON i.order_number = o.order_number WHERE o.is_paid AND CAST(o.pay_time AS DATE) {_ON} GROUP BY 1, 2),
r AS (SELECT prod_id, shop_id, {_REFUND_COUNTS} FROM (
        SELECT i.prod_id, i.shop_id, r.refund_id, r.user_id, r.return_money_sts = 5 AS ok, r.refund_amount AS amount
        FROM rd r JOIN id i ON i.order_item_id = r.order_item_id WHERE r.refund_type = 2
        UNION ALL
        SELECT i.prod_id, i.shop_id, r.refund_id, r.user_id, r.return_money_sts = 5, r.refund_amount
        FROM rd r JOIN od o ON o.order_id = r.order_id JOIN id i ON i.order_number = o.order_number
        WHERE r.refund_type = 1 AND CAST(o.create_time AS DATE) {_ON}) GROUP BY 1, 2),
snap AS (SELECT DISTINCT i.prod_id, o.shop_id, i.prod_name AS iname, i.price AS iprice, i.status AS istatus
         FROM od o JOIN id i ON i.order_number = o.order_number),
pin AS (SELECT DISTINCT prod_id, shop_id, status AS tstatus FROM prd WHERE NOT is_deleted AND dt {_ON}),
x AS (SELECT cards.*, e.ex, e.exp, o.ou, o.oc, o.oa, p.pu, p.pc, p.pa, r.rn, r.rp, r.sn, r.sp, r.sa, iname, iprice,
             coalesce(tstatus, istatus, cards.status, 0) AS st
      FROM cards LEFT JOIN e USING (prod_id, shop_id) LEFT JOIN o USING (prod_id, shop_id) LEFT JOIN p USING (prod_id, shop_id)
      LEFT JOIN r USING (prod_id, shop_id) LEFT JOIN snap USING (prod_id, shop_id) LEFT JOIN pin USING (prod_id, shop_id))
SELECT prod_id, shop_id, {_measures('coalesce(price, iprice, 0)', 'st')}, DATE '{DAY}' AS stat_date,
       coalesce(prod_name, iname, '商品_' || prod_id) AS prod_name, coalesce(pic, '') AS prod_url,
       coalesce(shop_name, '商家_' || shop_id) AS shop_name
FROM x LEFT JOIN shp USING (shop_id) JOIN {FILTERS} ON {ADMITS.format(s='st')}
WHERE {_ANY}
""")


def _platform_today(only: str = "") -> str:
    upto = f"apply_time >= TIMESTAMP '{DAY} 00:00:00' AND apply_time < TIMESTAMP '{DAY} 23:59:59'"
    return q(f"""cards AS (
  SELECT prod_id, shop_id, prod_name, price, supplier_price, status, pic FROM prd WHERE status > -1
  QUALIFY row_number() OVER (PARTITION BY prod_id
    ORDER BY update_time DESC, shop_id DESC, prod_name DESC, price DESC, supplier_price DESC, status DESC, pic DESC) = 1),
od AS (SELECT * FROM ord WHERE dt {_ON}), id AS (SELECT * FROM itm WHERE dt {_ON}),
rd AS (SELECT * FROM rfd WHERE dt {_ON} AND {upto}),
e AS (SELECT prod_id, count(*) AS ex, count(DISTINCT cid) AS exp FROM seen WHERE dt {_ON} GROUP BY 1),
o AS (SELECT i.prod_id, count(DISTINCT o.user_id) AS ou, count(DISTINCT o.user_id) FILTER (WHERE o.is_paid) AS pu,
         sum(i.prod_count) AS oc, sum(i.prod_count) FILTER (WHERE o.is_paid) AS pc,
         sum(i.actual_total) AS oa, sum(i.actual_total) FILTER (WHERE o.is_paid) AS pa
      FROM od o JOIN id i ON i.order_number = o.order_number WHERE {span('o.create_time', DAY, DAY)} GROUP BY 1),
r AS (SELECT prod_id, {_REFUND_COUNTS} FROM (
        SELECT i.prod_id, r.refund_id, r.user_id, r.return_money_sts = 5 AS ok, i.actual_total AS amount
        FROM rd r JOIN id i ON i.order_item_id = r.order_item_id WHERE r.refund_type = 2
        UNION ALL
        SELECT i.prod_id, r.refund_id, r.user_id, r.return_money_sts = 5, i.actual_total
        FROM rd r JOIN od o ON o.order_id = r.order_id JOIN id i ON i.order_number = o.order_number WHERE r.refund_type = 1)
      GROUP BY 1)
SELECT prod_id, {_measures()}, DATE '{DAY}' AS stat_date, prod_name, pic AS prod_url, shop_name
FROM cards LEFT JOIN e USING (prod_id) LEFT JOIN o USING (prod_id) LEFT JOIN r USING (prod_id) LEFT JOIN shp USING (shop_id)
JOIN {FILTERS} ON {ADMITS.format(s='status')}
WHERE (coalesce(ou, 0) > 0 OR coalesce(pu, 0) > 0 OR coalesce(rn, 0) > 0) {only}
""")


SQL["platform_product_analysis_today"] = _platform_today()
SQL["platform_product_analysis_today_by_status"] = _platform_today("AND sf.status_filter = '1'")
