"""Operators for large text collections used as training data.

Nothing outside this subpackage imports it. Every operator works on whole tables and whole
texts, keyed by an integer id, and returns only its own columns, so columns of the input with
clashing names cannot disturb it.
"""
