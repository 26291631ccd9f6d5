"""Slice and retention rules of result tables."""

from __future__ import annotations

from oracles.prelude import ADMITS, FILTERS, money, q, span

DAY = "2024-01-30"
SQL: dict[str, str] = {}

_HIST = f"""h AS (
  SELECT shop_id, CAST(pay_time AS DATE) AS stat_date, count(*) AS pay_order_count, {money('sum(actual_total)')} AS pay_actual_total
  FROM ord WHERE is_paid GROUP BY 1, 2),
n AS (
  SELECT shop_id, stat_date, pay_order_count + 1 AS pay_order_count, CAST(pay_actual_total + 1 AS DECIMAL(18,2)) AS pay_actual_total
  FROM h WHERE stat_date = DATE '{DAY}')"""
_COLS = "shop_id, pay_order_count, pay_actual_total"

SQL["replace_stat_date"] = q(f"""{_HIST}
SELECT {_COLS}, stat_date FROM h WHERE stat_date <> DATE '{DAY}' UNION ALL SELECT {_COLS}, stat_date FROM n
""")
SQL["keep_only_new"] = q(f"{_HIST} SELECT shop_id, stat_date, pay_order_count, pay_actual_total FROM n")
SQL["rolling_month"] = q(f"""{_HIST}
SELECT {_COLS}, stat_date - 20 AS stat_date FROM h WHERE stat_date - 20 > DATE '2023-12-30'
UNION ALL SELECT {_COLS}, stat_date FROM n
""")
SQL["rolling_two_days"] = q(f"""{_HIST}
SELECT {_COLS}, stat_date FROM h WHERE stat_date NOT IN (DATE '2024-01-28', DATE '{DAY}') UNION ALL SELECT {_COLS}, stat_date FROM n
""")
SQL["replace_all_or_month"] = q(f"""{_HIST}
SELECT {_COLS}, stat_date - 20 AS stat_date FROM h WHERE stat_date - 20 < DATE '2024-01-01'
UNION ALL SELECT {_COLS}, stat_date FROM n
""")
SQL["replace_current_day"] = q(f"""{_HIST}
SELECT {_COLS}, stat_date AS current_day FROM h WHERE stat_date <> DATE '{DAY}'
UNION ALL SELECT {_COLS}, stat_date AS current_day FROM n
""")


def _paid(first: str, last: str, stat: str, tag: str, tag_name: str, time_type: int, more: int = 0) -> str:
    return f"""SELECT shop_id, count(*) + {more} AS pay_order_count, CAST(sum(actual_total) + {more} AS DECIMAL(18,2)) AS pay_actual_total,
  DATE '{stat}' AS stat_date, '{tag}' AS {tag_name}, {time_type} AS time_type
FROM ord WHERE is_paid AND {span('pay_time', first, last)} GROUP BY shop_id"""


# days 23, 28 and 29 keep their daily rows; weeks keep week 4 (asked on the 23rd and 28th); the day, its week and the month are new
SQL["replace_period"] = q(" UNION ALL ".join([
    *[_paid(d, d, d, d.replace("-", ""), "date_time", 1) for d in ("2024-01-23", "2024-01-28", "2024-01-29")],
    _paid(DAY, DAY, DAY, "20240130", "date_time", 1, 1),
    _paid("2024-01-22", "2024-01-23", "2024-01-23", "202404", "date_time", 2),
    _paid("2024-01-22", "2024-01-28", "2024-01-28", "202404", "date_time", 2),
    _paid("2024-01-29", DAY, DAY, "202405", "date_time", 2, 1),
    _paid("2024-01-01", DAY, DAY, "202401", "date_time", 3, 1),
]))
SQL["replace_time_period"] = q(" UNION ALL ".join([
    _paid("2024-01-24", DAY, "2024-01-31", "7", "time_period", 0, 1),
    _paid("2024-01-01", DAY, "2024-01-31", "30", "time_period", 0, 1),
    _paid("2024-01-01", DAY, DAY, "202401", "time_period", 0, 1),
]))
SQL["assert_unique_key"] = q(f"""
SELECT prod_id, shop_id, dt AS stat_date, sf.status_filter, count(*) AS row_count
FROM prd JOIN {FILTERS} ON {ADMITS.format(s='status')} GROUP BY 1, 2, 3, 4 HAVING count(*) > 1
""")
