"""ticktale: price-and-news analytics expressed as Spark DataFrame jobs.

Layout
------
sources/    readers for the input tables and the fixture views built on them
functions/  column-expression helpers (text, dates, statistics, kernels)
operators/  the study's operators, one module per area (bars, backtest, ...)
plans/      the query registry (name -> DataFrame builder) and DuckDB oracles
streaming/  the incremental article intake as a Structured Streaming job
"""

__all__ = ["session"]
