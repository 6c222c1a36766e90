"""Operators of a training-data pipeline over documents, pages and conversations.

One module per operator; ``queries`` registers them over whole tables. Nothing outside
this subpackage imports it.
"""
