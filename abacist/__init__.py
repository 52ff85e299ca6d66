"""Abacist: business-data analytics as lazy Spark DataFrame operators."""
