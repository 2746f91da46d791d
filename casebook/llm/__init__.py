"""Operators for large training-data pipelines.

Thirteen operators over the ``documents``, ``pages`` and ``embeddings`` tables. Nothing
outside this package imports it; ``__spark_entry__.py`` adds its queries when it is
there. ``queries.py`` registers one ``opN_<name>`` query for each operator.
"""
