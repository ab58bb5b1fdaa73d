"""Operators that prepare text corpora for training language models.

Nothing else in the library imports this subpackage. Every operator takes and returns DataFrames and works on whole
tables and whole texts; where several jobs read one result, that result is written to the shared folder first.
"""
