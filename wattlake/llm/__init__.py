"""Training-data operators (language id, URL rules, dedup, mixing, ...).

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``queries`` registers the thin ``opN_*``
queries over the driver's tables and ``oracle`` their DuckDB twins.
"""
