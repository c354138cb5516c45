"""Operators of a training-data pipeline: decontamination, URL rules, near-duplicates, HTML text,
personal data, language, quality rules, line duplicates, SentencePiece and quality scoring.

Nothing else in the library imports this sub-package.
"""
