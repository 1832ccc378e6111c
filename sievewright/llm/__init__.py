"""Operators that prepare text corpora for training language models.

Nothing else in the library imports this package. Every operator reads whole
texts and takes words as runs of characters other than ASCII white space.
"""
