"""Operators: DataFrame in, DataFrame out, explicit key."""
