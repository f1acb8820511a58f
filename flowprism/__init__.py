"""flowprism: Spark-native cleaning, feature, class-balance and evaluation operators for flow-log tables."""

__version__ = "0.1.0"
