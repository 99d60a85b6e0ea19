"""Operators from DataFrame to DataFrame, and the MLlib estimators around them."""
