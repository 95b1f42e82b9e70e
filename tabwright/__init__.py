"""Tabular feature engineering, out-of-fold learning and stacking on Spark DataFrames."""
