"""Reading and typing of the logical tables."""

from stallmetrics.sources.marketplace import Marketplace

__all__ = ["Marketplace"]
