"""Operators for preparing language-model training data.

Nothing else of the library imports this subpackage.  ``queries`` registers one query
per operator; ``corpus_pipeline`` at the top of the repository chains five of them.
"""
