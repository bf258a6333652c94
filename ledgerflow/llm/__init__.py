"""Training-data operators: one module per operator, ``queries`` registers them.

Nothing else in the library imports this package.  Each module keeps a general
operator and a thin ``opN_<name>`` query that derives the asked columns.
"""
