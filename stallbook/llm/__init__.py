"""Operators for training-data pipelines: one module per operator, `queries` for the registered queries.

Nothing else in the library imports this subpackage. Columns that an operator reads are arguments; other columns of
the input are left alone. Where an operator adds columns to the input, a column of that name is replaced.
"""
