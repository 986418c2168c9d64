"""Training-data operators: fingerprints, archives, language ID, dedup, mixing, tokenising.

Nothing else in the package imports this folder; ``queries`` registers one query
per operator and ``corpus_pipeline`` (repository top) chains four of them.
"""
