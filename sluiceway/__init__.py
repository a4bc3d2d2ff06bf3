"""Declarative data loading on Spark: every operator is a DataFrame-to-DataFrame function."""
