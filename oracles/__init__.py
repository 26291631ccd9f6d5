"""Independent SQL (DuckDB) for every named query, over the same tables."""

from oracles.analysis import SQL as _analysis
from oracles.merchant import SQL as _merchant
from oracles.products import SQL as _products
from oracles.steps import SQL as _steps
from oracles.tables import SQL as _tables

ORACLES: dict[str, str] = _merchant | _products | _analysis | _steps | _tables

# Reports through the raw layer give what the typed tables give.
_RAW = (
    "merchant_paid_yesterday", "merchant_hourly_gmv", "merchant_daily_order_pay", "merchant_comprehensive_all", "merchant_refund_stats",
    "refund_product_rank", "refund_reason_rank", "product_overview_period_all", "product_overview_daily_intraday", "product_sales_rank_30",
    "product_visitor_conversion_30", "merchant_product_analysis_all", "merchant_product_analysis_today", "platform_product_analysis_all",
    "platform_product_analysis_today", "app_log_label_expand",
)
ORACLES = {f"raw_{name}": ORACLES[name] for name in _RAW} | ORACLES
