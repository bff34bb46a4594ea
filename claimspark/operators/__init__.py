"""Relational and analytic operators (DataFrame in, DataFrame out)."""
