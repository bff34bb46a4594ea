"""Operators of a training-data pipeline, one module each, and their queries.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
