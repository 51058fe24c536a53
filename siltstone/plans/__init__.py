"""Predicates, pruning, order and the choice of a reader."""
