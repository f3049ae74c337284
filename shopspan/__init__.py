"""Household retention analytics expressed as Spark DataFrame transformations."""
