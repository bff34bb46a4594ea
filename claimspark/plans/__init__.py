"""Composed plans: the multi-step jobs (transform, feature, training) and the
SQL text used as an independent oracle for the DataFrame operators."""
