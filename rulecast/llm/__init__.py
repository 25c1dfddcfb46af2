"""Operators for preparing language-model training data; see ``registry`` for their queries."""
