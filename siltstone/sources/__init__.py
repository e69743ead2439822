"""Reading and writing tables: date partitions, databases, CSV, catalog."""
