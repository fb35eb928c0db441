"""Training-data operators: dedup, extraction, filtering, scoring, packing and archiving of text at scale.

Nothing else in the library imports this subpackage.
"""
