"""Operators of a training-data pipeline over ``documents``, ``embeddings`` and ``conversations``.

One module per operator; ``queries`` registers each over its whole table.
Nothing else in the library imports this subpackage.
"""
