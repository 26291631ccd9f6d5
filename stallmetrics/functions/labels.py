"""Readable labels for coded columns."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Product status codes and the texts reports show for them.
PRODUCT_STATUS = {
    -1: "删除",
    0: "商家下架",
    1: "上架",
    2: "平台下架",
    3: "违规下架待审核",
    6: "待审核",
    7: "草稿状态",
}

# buyer's refund reason codes and texts. Code 9 has no text and stays as it is.
REFUND_REASON = {
    "0": "拍错/多拍/不喜欢",
    "1": "协商一致退款",
    "2": "商品破损/少件",
    "3": "商品与描述不符",
    "4": "卖家发错货",
    "5": "质量问题",
    "6": "其他",
    "7": "拼团失败：系统自动退款",
    "8": "发货超时：系统自动退款",
    "10": "不想要了",
    "11": "看到更便宜的商品",
    "12": "商品款式选错了",
    "13": "收货地址/手机号填错了",
    "14": "有优惠未使用",
    "15": "缺货",
    "16": "未按承诺时间发货",
    "17": "其他原因",
}

# Fallback names.
UNKNOWN_PRODUCT = "未知商品"
PRODUCT_PREFIX = "商品_"
SHOP_PREFIX = "商家_"


def _lookup(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])


def product_status_label(status: Column | str) -> Column:
    """Text of a product status; empty for codes without one."""
    status = F.col(status) if isinstance(status, str) else status
    return F.coalesce(F.try_element_at(_lookup(PRODUCT_STATUS), status), F.lit(""))


def refund_reason_label(reason: Column | str) -> Column:
    """Text of a refund reason; codes without one keep the raw code."""
    reason = F.col(reason) if isinstance(reason, str) else reason
    return F.coalesce(F.try_element_at(_lookup(REFUND_REASON), reason), reason)
