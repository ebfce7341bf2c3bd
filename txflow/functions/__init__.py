"""Scalar column functions and fixed vocabularies."""
