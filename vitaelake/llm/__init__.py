"""Operators for training-data corpora: cleaning, de-duplication, scoring and packing.

Nothing else in the library imports this subpackage. Each module holds one operator with its own
interface; ``queries`` derives the registered queries from them.
"""
