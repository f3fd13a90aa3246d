"""hashloom: a PySpark-native engine for large sets of 64-bit sequence-sketch hashes."""

__version__ = "0.1.0"
