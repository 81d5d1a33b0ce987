"""Operators for training-data pipelines over text, vectors, pages and conversations.

Nothing else in the library imports this subpackage. ``queries`` holds the registered
queries and their SQL; each operator has a module of its own.
"""
