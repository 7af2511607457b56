"""Training-data operators: tokenisation, deduplication, filtering, redaction and formatting.

Nothing else in the library imports this subpackage.
"""
