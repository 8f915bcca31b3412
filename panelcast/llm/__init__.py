"""Training-data operators: dedup, language, quality, toxicity, extraction, mixing.

Nothing else in the package imports this subpackage.  Each module holds one
operator; ``queries`` binds them to the registered ``opN_*`` queries.
"""
