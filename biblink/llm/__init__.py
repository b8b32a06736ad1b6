"""Training-data operators: formatting, filtering, deduplication, scoring, mixing, sharding.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``queries`` registers the thin contract
queries on top of them.
"""
