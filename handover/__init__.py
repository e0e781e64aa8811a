"""handover: a Spark-native migration, data-quality, reporting and audit library."""

__version__ = "0.1.0"
