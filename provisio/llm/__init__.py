"""Operators for building language-model training data: near-duplicate and
line de-duplication, licence scans, source mixing, token counts, language-model
scoring, language identification, quality rules, fingerprints and packing.

Nothing outside this package imports it. ``queries.py`` registers one query
per operator; ``corpus_pipeline.py`` at the repository top chains five.
"""
