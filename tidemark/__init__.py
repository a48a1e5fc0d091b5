"""Layered commerce analytics on Spark: landing, cleaning, gold tables, checks and a DataFrame operator library."""
