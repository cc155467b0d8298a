"""Retail sales analytics as plain Spark DataFrame operators."""
