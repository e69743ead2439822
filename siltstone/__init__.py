"""Layered batch analytics (bronze, silver, gold, reports) as PySpark DataFrame plans."""
