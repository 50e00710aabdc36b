"""Training-data preparation operators (one module per operator).

Nothing else in the library imports this package; ``queries`` registers the
operators as queries and ``__spark_entry__`` adds them when it is present.
"""
