"""Operators that prepare text for training: one module per operator, ``queries`` for the registered ones."""
