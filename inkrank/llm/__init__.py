"""Operators for preparing training data; see ``queries`` for how each is run."""
