"""Operators of a training-data pipeline over ``documents``, ``pages``, ``conversations`` and ``embeddings``.

Nothing else in the library imports this package.  ``queries.py`` names the
queries ``op1_`` .. ``op10_``; ``corpus_pipeline.py`` chains five of them.
"""
