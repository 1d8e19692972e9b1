"""Training-data operators: search, language, quality, privacy, toxicity, tokens, mixing, extraction, near-duplicates.

Nothing else in the library imports this subpackage.
"""
