"""churnwatch: Spark-native cleaning, feature, evaluation and drift-monitoring operators.

Every public operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, aggregates, joins and windows, so Catalyst plans it and the work is
spread over the cluster. See README.md for the operator map.
"""

__version__ = "0.1.0"
