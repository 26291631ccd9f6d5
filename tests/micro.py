"""Small hand-written frames in the typed schemas."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from stallmetrics.sources import schemas


def _value(name, value):
    if isinstance(value, str) and (name.endswith("_time")):
        return datetime.fromisoformat(value)
    if isinstance(value, str) and name == "dt":
        return date.fromisoformat(value)
    if name in ("actual_total", "refund_amount", "price", "supplier_price") and value is not None:
        return Decimal(str(value))
    return value


def frame(spark, schema, rows):
    """Rows as dicts; missing columns are NULL."""
    return spark.createDataFrame(
        [tuple(_value(f.name, r.get(f.name)) for f in schema.fields) for r in rows], schema
    )


def orders(spark, *rows):
    return frame(spark, schemas.ORDER, [{"is_paid": False, "status": 1, "order_number": f"n{r.get('order_id')}"} | r for r in rows])


def items(spark, *rows):
    return frame(spark, schemas.ITEM, rows)


def refunds(spark, *rows):
    return frame(spark, schemas.REFUND, rows)


def products(spark, *rows):
    return frame(spark, schemas.PRODUCT, [{"is_deleted": False, "status": 1, "update_time": "2024-01-01"} | r for r in rows])


def shops(spark, *rows):
    return frame(spark, schemas.SHOP, rows)


def app_log(spark, *rows):
    base = {"action": "enter", "page_id": "1005", "event": "AppViewScreen", "label": "{}"}
    return frame(spark, schemas.APP_LOG, [base | r for r in rows])
