"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage; ``queries.py`` registers
one query per operator and ``corpus_pipeline.py`` chains five of them.
"""
