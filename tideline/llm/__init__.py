"""Operators of a training-data pipeline over the document tables.

Nothing outside this package imports it. Every operator is a
``DataFrame -> DataFrame`` function; :mod:`tideline.llm.queries` registers one
query per operator.
"""
