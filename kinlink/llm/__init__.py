"""Operators for preparing language-model training corpora.

Each module holds one operator with a general interface; ``queries`` binds
them to the driver's tables.  Nothing outside this package imports it.
"""
