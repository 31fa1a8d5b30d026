"""Layered transaction analytics (bronze, silver, gold) as Spark DataFrame plans."""
