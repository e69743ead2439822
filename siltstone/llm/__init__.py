"""Operators that prepare text for training models, each a Spark job of its own."""
