"""ledgerlens: business-analytics operators and catalogue queries on Spark.

Every operator is expressed with DataFrame / Spark SQL expressions so Catalyst
can prune, push down and plan the shuffles; no row-at-a-time Python UDFs.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
