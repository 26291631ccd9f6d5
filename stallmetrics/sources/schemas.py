"""Typed schemas of the logical tables. Ids are long, money decimal(18,2), times timestamps, ``dt`` a date."""

from __future__ import annotations

from pyspark.sql import types as T

_MONEY = T.DecimalType(18, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


ORDER = _struct(
    order_id=T.LongType(), order_number=T.StringType(), user_id=T.LongType(), shop_id=T.LongType(),
    create_time=T.TimestampType(), pay_time=T.TimestampType(), is_paid=T.BooleanType(), actual_total=_MONEY,
    status=T.IntegerType(), prod_name=T.StringType(), dt=T.DateType(),
)

ITEM = _struct(
    order_item_id=T.StringType(), order_number=T.StringType(), prod_id=T.LongType(), shop_id=T.LongType(),
    user_id=T.LongType(), prod_count=T.IntegerType(), actual_total=_MONEY, price=_MONEY,
    prod_name=T.StringType(), status=T.IntegerType(), rec_time=T.TimestampType(), dt=T.DateType(),
)

REFUND = _struct(
    refund_id=T.StringType(), order_id=T.LongType(), order_item_id=T.StringType(), user_id=T.LongType(),
    shop_id=T.LongType(), refund_type=T.IntegerType(), return_money_sts=T.IntegerType(), refund_amount=_MONEY,
    apply_time=T.TimestampType(), refund_time=T.TimestampType(), goods_num=T.IntegerType(),
    buyer_reason=T.StringType(), dt=T.DateType(),
)

PRODUCT = _struct(
    prod_id=T.LongType(), shop_id=T.LongType(), prod_name=T.StringType(), price=_MONEY, supplier_price=_MONEY,
    status=T.IntegerType(), pic=T.StringType(), create_time=T.TimestampType(), update_time=T.TimestampType(),
    is_deleted=T.BooleanType(), dt=T.DateType(),
)

SHOP = _struct(shop_id=T.LongType(), shop_name=T.StringType(), dt=T.DateType())

APP_LOG = _struct(
    prod_id=T.LongType(), shop_id=T.LongType(), cid=T.StringType(), action=T.StringType(), page_id=T.StringType(),
    event=T.StringType(), label=T.StringType(), dt=T.DateType(),
)

# Fields of an app-log label that reports read.
LABEL = _struct(isShare=T.StringType())

# A user row, as the change-log stream carries it.
USER = _struct(
    id=T.LongType(), username=T.StringType(), password=T.StringType(), email=T.StringType(), phone=T.StringType()
)
