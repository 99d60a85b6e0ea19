"""Tabular cleaning, grouped imputation and model comparison as Spark DataFrame plans."""
