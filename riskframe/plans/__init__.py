"""Compositions of operators (evaluation, audit, training) and the query catalog."""
