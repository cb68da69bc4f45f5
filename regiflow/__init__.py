"""regiflow: a Spark-native engine for company-registry data.

Raw registry text is cleaned with column expressions, typed with a reject
table, tracked in an append-only file-state log and reported on with
DataFrame aggregations and joins that Catalyst plans and AQE adapts.
"""

__version__ = "0.1.0"
