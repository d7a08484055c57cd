"""ordertide: a Spark-native order-analytics pipeline.

Ingests orders from fixed-width, tab- and comma-separated, XML and streaming
JSON files, normalizes them into typed tables with lineage and month
partitions, keeps versioned snapshots, answers business questions and reports
data quality as ordinary result tables.  Everything is expressed with the
DataFrame / SQL API so Catalyst plans it; nothing passes whole through the
driver.
"""

__version__ = "0.1.0"
