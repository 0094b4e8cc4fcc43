"""Operators for preparing language-model training data at scale.

Nothing outside this subpackage imports it; the rest of the library works without it.
"""
