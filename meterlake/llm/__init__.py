"""Operators that prepare text for training, each one a Spark job over whole tables."""
