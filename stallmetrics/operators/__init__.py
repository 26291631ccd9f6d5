"""Reusable DataFrame steps: windows, traffic, catalog, trade, refunds, shaping, ranking."""
