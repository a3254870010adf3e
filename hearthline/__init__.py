"""Hearthline: tabular regression analytics on Spark DataFrames.

``sources``    reading and writing tables, fit state, models, run and audit records
``functions``  column expressions without state
``operators``  DataFrame-to-DataFrame operators and their fits
``plans``      whole flows composed of operators
``streaming``  the same operators over Structured Streaming
``catalog``    the queries that are checked against SQL
"""
