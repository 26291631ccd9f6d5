"""Logical tables as SQL, and small builders for repeated expressions."""

from __future__ import annotations

BINDING = """
WITH hdr AS (
  SELECT o_orderkey, user_id, is_paid, dt, CAST(dt AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS INT)) AS create_time,
         CAST(dt AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 + o_orderkey % 5 * 7 AS INT)) AS paid_time
  FROM (
    SELECT o_orderkey, o_custkey AS user_id, o_orderstatus IN ('F', 'P') AS is_paid,
           DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30 AS INT) AS dt
    FROM orders)
),
ln AS (
  SELECT l.*, h.user_id, h.is_paid, h.dt, h.create_time, h.paid_time,
         CAST(l_quantity AS INT) AS qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS amt,
         concat_ws('-', l_orderkey, l_suppkey) AS order_number,
         l_orderkey * 100000 + l_suppkey AS order_id,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT),
                   CAST(l_extendedprice AS DECIMAL(18,2))) AS item_key
  FROM lineitem l JOIN hdr h ON l.l_orderkey = h.o_orderkey
),
itm AS (
  SELECT item_key AS order_item_id, order_number, l_partkey AS prod_id, l_suppkey AS shop_id, user_id,
         qty AS prod_count, amt AS actual_total, create_time AS rec_time, dt
  FROM ln
),
itmn AS (
  SELECT i.*, CAST(p_retailprice AS DECIMAL(18,2)) AS price, p_name AS prod_name, p_size % 9 - 1 AS status
  FROM itm i JOIN part ON p_partkey = i.prod_id
),
ord AS (
  SELECT order_id, order_number, user_id, l_suppkey AS shop_id, create_time,
         CASE WHEN is_paid THEN paid_time END AS pay_time, is_paid,
         CAST(sum(amt) AS DECIMAL(18,2)) AS actual_total, CASE WHEN is_paid THEN 2 ELSE 1 END AS status, dt
  FROM ln GROUP BY order_id, order_number, user_id, l_suppkey, create_time, paid_time, is_paid, dt
),
rfd AS (
  SELECT item_key AS refund_id, order_id, CASE WHEN l_linestatus = 'O' THEN item_key END AS order_item_id, user_id,
         l_suppkey AS shop_id, CASE WHEN l_linestatus = 'O' THEN 2 ELSE 1 END AS refund_type,
         CASE WHEN l_returnflag = 'R' THEN 5 ELSE 1 END AS return_money_sts, amt AS refund_amount,
         create_time + to_days(qty % 7) AS apply_time,
         CASE WHEN l_returnflag = 'R' THEN create_time + to_days(qty % 7) END AS refund_time,
         CASE WHEN l_linestatus = 'O' THEN qty END AS goods_num, CAST(l_partkey % 18 AS VARCHAR) AS buyer_reason,
         CAST(create_time + to_days(qty % 7) AS DATE) AS dt
  FROM ln WHERE l_returnflag IN ('R', 'A')
),
prd AS (
  SELECT l_partkey AS prod_id, l_suppkey AS shop_id, p_name AS prod_name,
         CAST(p_retailprice AS DECIMAL(18,2)) AS price, CAST(l_extendedprice AS DECIMAL(18,2)) AS supplier_price,
         p_size % 9 - 1 AS status, 'pic/' || l_partkey AS pic,
         CAST(DATE '2024-01-01' + CAST(l_partkey % 30 AS INT) AS TIMESTAMP) AS create_time,
         CAST(l_shipdate AS TIMESTAMP) AS update_time, DATE '2024-01-01' + CAST(l_partkey % 30 AS INT) AS dt,
         l_partkey % 11 = 0 AS is_deleted
  FROM lineitem JOIN part ON p_partkey = l_partkey
),
shp AS (SELECT s_suppkey AS shop_id, s_name AS shop_name FROM supplier),
app AS (
  SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS prod_id, event_id % 10 AS shop_id,
         CAST(user_id AS VARCHAR) AS cid, CASE WHEN event_type = 'view' THEN 'enter' ELSE event_type END AS action,
         event_id % 7 <> 0 AS on_page, event_id % 3 = 0 AND event_id % 5 <> 0 AS shared, CAST(ts AS DATE) AS dt
  FROM events
),
seen AS (SELECT * FROM app WHERE action = 'enter' AND on_page)
"""

# windows the reports are asked for: name -> (first day, last day, tag, stat date)
SPANS = {
    "7": ("2024-01-24", "2024-01-30", "7", "2024-01-31"),
    "30": ("2024-01-01", "2024-01-30", "30", "2024-01-31"),
    "month": ("2024-01-01", "2024-01-30", "202401", "2024-01-30"),
}


def q(body: str) -> str:
    """Body (more common table expressions, then a select) over the logical tables."""
    body = body.strip()
    return BINDING + ("," + body if not body.upper().startswith("SELECT") else body)


def span(col: str, first: str, last: str) -> str:
    return f"({col} >= TIMESTAMP '{first} 00:00:00' AND {col} < TIMESTAMP '{last} 00:00:00' + INTERVAL 1 DAY)"


def days(col: str, first: str, last: str) -> str:
    return f"{col} BETWEEN DATE '{first}' AND DATE '{last}'"


def ratio(num: str, den: str, places: int, times: int = 1) -> str:
    """num / den * times, rounded half up in whole-number arithmetic; 0 without a denominator."""
    n = f"CAST(coalesce({num}, 0) * 100 AS HUGEINT)"
    d = f"CAST(coalesce({den}, 0) * 100 AS HUGEINT)"
    unit = "1" if places == 0 else "0." + "0" * (places - 1) + "1"
    units = f"({n} * {2 * times * 10**places} + {d}) // (2 * {d})"
    return (
        f"CASE WHEN coalesce({den}, 0) > 0 THEN CAST(CAST({units} AS DECIMAL(15,0)) * "
        f"CAST({unit} AS DECIMAL({places + 1},{places})) AS DECIMAL(18,{places})) "
        f"ELSE CAST(0 AS DECIMAL(18,{places})) END"
    )


def money(expr: str) -> str:
    return f"CAST(coalesce({expr}, 0) AS DECIMAL(18,2))"


def whole(expr: str) -> str:
    return f"CAST(coalesce({expr}, 0) AS BIGINT)"


STATUS_TEXT = """CASE {s} WHEN -1 THEN '删除' WHEN 0 THEN '商家下架' WHEN 1 THEN '上架' WHEN 2 THEN '平台下架'
  WHEN 3 THEN '违规下架待审核' WHEN 6 THEN '待审核' WHEN 7 THEN '草稿状态' ELSE '' END"""

REASON_TEXT = """CASE {r} WHEN '0' THEN '拍错/多拍/不喜欢' WHEN '1' THEN '协商一致退款' WHEN '2' THEN '商品破损/少件'
  WHEN '3' THEN '商品与描述不符' WHEN '4' THEN '卖家发错货' WHEN '5' THEN '质量问题' WHEN '6' THEN '其他'
  WHEN '7' THEN '拼团失败：系统自动退款' WHEN '8' THEN '发货超时：系统自动退款' WHEN '10' THEN '不想要了'
  WHEN '11' THEN '看到更便宜的商品' WHEN '12' THEN '商品款式选错了' WHEN '13' THEN '收货地址/手机号填错了'
  WHEN '14' THEN '有优惠未使用' WHEN '15' THEN '缺货' WHEN '16' THEN '未按承诺时间发货' WHEN '17' THEN '其他原因'
  ELSE {r} END"""


def status_text(col: str) -> str:
    return STATUS_TEXT.format(s=col)


def reason_text(col: str) -> str:
    return REASON_TEXT.format(r=col)


FILTERS = "(VALUES ('0', NULL), ('1', 1), ('2', 0), ('3', 3)) AS sf(status_filter, wanted)"
ADMITS = "({s} = sf.wanted OR (sf.status_filter = '0' AND {s} > -1))"
