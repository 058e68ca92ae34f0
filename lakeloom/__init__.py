"""Spark-native marketplace lakehouse: raw text to star schema to business marts."""
