"""Operators for preparing training text at scale, and their registered queries.

Each module holds one operator with its own interface; ``queries`` derives the registered
``opN_*`` results from them.  Nothing else in the library imports this subpackage.
"""
