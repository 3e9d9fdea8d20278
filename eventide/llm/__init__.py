"""Operators for preparing text corpora for language-model training.

Nothing else in the library imports this subpackage. Each module holds one operator with a
general interface; ``queries`` binds them to the registered queries and holds their SQL.
"""
