"""Operators for preparing text corpora for language-model training.

Nothing outside this package imports it.  Each module holds one operator with its own interface; ``queries`` registers
them for the test tables.
"""
