"""Agro-climate analytics as Spark DataFrame operators."""
