"""pricefold: cross-source price comparison and arbitrage detection on Spark.

Batch operators live in ``pricefold.operators``, column functions in
``pricefold.functions``, readers in ``pricefold.sources``, writers in
``pricefold.sinks``, stateful streaming in ``pricefold.streaming`` and the
registered queries (with their DuckDB oracles) in ``pricefold.plans``.
"""

__version__ = "0.1.0"
