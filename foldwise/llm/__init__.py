"""Operators of a training-data pipeline: near duplicates, decontamination, language, toxicity, secrets, mixing.

Nothing else in the library imports this subpackage.  ``queries.py`` holds the registered
queries and their SQL; ``corpus_pipeline.py`` at the repository top chains five operators.
"""
