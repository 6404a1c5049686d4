"""Operators for preparing language-model training corpora.

Nothing outside this sub-package imports it.
"""
