"""Spark-native ledger analytics: every operator is a DataFrame -> DataFrame
(or Column -> Column) transformation planned by Catalyst."""

__version__ = "0.1.0"
