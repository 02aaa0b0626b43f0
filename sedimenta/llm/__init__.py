"""Operators for preparing language-model training data.

Each module holds one operator with its own general interface; ``queries`` has
the registered query of each, and ``corpus_pipeline.py`` chains five of them.
"""
