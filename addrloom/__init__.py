"""Spark-native address analytics: sources, operators, plans and streams on DataFrames."""
