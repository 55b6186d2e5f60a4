"""Spark-native toolkit for aligning, publishing, exporting and accounting a multi-tenant data lake."""
