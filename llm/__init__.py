"""Operators of a training-data pipeline over ``documents`` and ``embeddings``.

Nothing outside this folder imports it, except ``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
