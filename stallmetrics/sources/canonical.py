"""Raw warehouse frames (mostly text columns) to the typed schemas.

The only place where casts happen: reports and steps rely on the types in ``schemas``. Columns a raw table
lacks become NULL. Flags accept every spelling in use (``1``, ``'1'``, ``'true'``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallmetrics.functions import casts
from stallmetrics.sources import schemas

_RENAMED = {
    "is_paid": "is_payed",
    "is_deleted": "is_delete_hive",
}
_RENAMED_LOG = {"prod_id": "prodid", "shop_id": "shopid"}
# texts kept as they are: a blank name or reason is data, not a missing id
_VERBATIM = {"prod_name", "shop_name", "buyer_reason", "label", "pic"}

# texts in which blank stands for "none", so that blanks must not meet each other in a join
_OPTIONAL_TEXT = {"order_item_id"}


def _typed(raw: DataFrame, field: T.StructField, renamed: dict[str, str]) -> Column:
    source = next((n for n in (renamed.get(field.name), field.name) if n in raw.columns), None)
    if source is None:
        return F.lit(None).cast(field.dataType).alias(field.name)
    typed_already = dict(raw.dtypes)[source] == field.dataType.simpleString()
    if typed_already and isinstance(field.dataType, T.BooleanType):
        col = F.coalesce(F.col(source), F.lit(False))
    elif typed_already and field.name not in _OPTIONAL_TEXT:
        # left bare, so that filters and joins on it still reach the scan
        col = F.col(source)
    elif field.name in _VERBATIM:
        col = F.col(source).cast("string")
    elif isinstance(field.dataType, T.LongType):
        col = casts.as_id(source)
    elif isinstance(field.dataType, T.IntegerType):
        col = casts.as_int(source)
    elif isinstance(field.dataType, T.DecimalType):
        col = casts.as_money(source)
    elif isinstance(field.dataType, T.BooleanType):
        col = casts.as_flag(source)
    elif isinstance(field.dataType, T.TimestampType):
        col = casts.as_moment(source)
    elif isinstance(field.dataType, T.DateType):
        col = casts.as_day(source)
    else:
        col = casts.as_text(source)
    return col.alias(field.name)


def conform(raw: DataFrame, schema: T.StructType, renamed: dict[str, str] | None = None) -> DataFrame:
    """Project ``raw`` onto ``schema`` with safe casts. A ``dt`` that is a date already stays prunable."""
    renamed = _RENAMED | (renamed or {})
    return raw.select(*[_typed(raw, field, renamed) for field in schema.fields])


def orders(raw: DataFrame) -> DataFrame:
    return conform(raw, schemas.ORDER)


def items(raw: DataFrame) -> DataFrame:
    return conform(raw, schemas.ITEM)


def refunds(raw: DataFrame) -> DataFrame:
    return conform(raw, schemas.REFUND)


def products(raw: DataFrame) -> DataFrame:
    return conform(raw, schemas.PRODUCT)


def shops(raw: DataFrame) -> DataFrame:
    return conform(raw, schemas.SHOP)


def app_log(raw: DataFrame) -> DataFrame:
    return conform(raw, schemas.APP_LOG, _RENAMED_LOG)
