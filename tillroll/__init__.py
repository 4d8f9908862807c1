"""tillroll: Spark-native analytics for order-level retail sales drops.

Raw daily order files are scanned into a typed DataFrame, profiled for data
quality, cleaned (default filling, sign repair, keep-first deduplication,
return exclusion, exact decimal revenue) and answered with lazy DataFrames:
business questions, exploratory tables, KPIs and significance tests.

Every function takes and returns DataFrames; nothing larger than a grouped
summary is ever pulled to the driver.
"""

__version__ = "0.1.0"
