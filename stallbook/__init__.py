"""Retail analytics as Spark DataFrame operators.

Sub-packages
------------
functions   column expressions shared by the operators
sources     readers, writers and the canonical input schemas
operators   one function per business table, DataFrame in and DataFrame out
plans       physical building blocks (staging, ranking), gold build, query registry
streaming   the live monitors as Structured Streaming queries
"""
