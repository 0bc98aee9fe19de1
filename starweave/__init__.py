"""starweave: a Spark-native star-schema warehouse toolkit.

Raw extracts are landed with audit columns (Bronze), cleaned, typed,
de-duplicated and quarantined (Silver), and assembled into Type 1
dimensions, a calendar and an order-line fact (Gold). Data-quality
suites run as single-pass aggregates and the sales reports are plain
DataFrame aggregations. Everything is built from Spark's own DataFrame
functions so Catalyst can prune, push down and code-generate the plans.
"""

__version__ = "0.1.0"
