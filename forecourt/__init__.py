"""Batch and streaming analytics for a multi-market vehicle marketplace, on Spark.

Everything is a plain function from DataFrames to a DataFrame; Catalyst and AQE
choose the physical plan. See README.md for the layer map.
"""

from forecourt.session import build_session

__all__ = ["build_session"]
