"""Operators over any DataFrame: profiling, correlation, policy series, features, scoring, imputation, load preparation."""
