"""Operators of a training-data pipeline over a ``documents`` table.

Each module holds one operator with a general interface (id and text columns
are parameters); ``queries.py`` derives the registered ``opN_<name>`` frames.
Nothing else in the library imports this package.
"""
