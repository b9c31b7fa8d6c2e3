"""Operators of a training-data pipeline over tables of documents.

Each takes DataFrames with at least ``doc_id`` and ``text`` and looks at no other column
unless it says so, so extra columns never clash. A null text counts as empty. Nothing
outside this folder imports it.
"""
