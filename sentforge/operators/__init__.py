"""Corpus operators: pure ``DataFrame -> DataFrame`` functions."""
