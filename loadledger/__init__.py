"""Revised time series on Spark: version resolution, key figures, quality gates."""

from loadledger.contract import SeriesContract

__all__ = ["SeriesContract"]
