"""Loomlex: a PySpark engine for concept vocabularies, their labels and their history."""
