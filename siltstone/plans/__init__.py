"""Whole pipelines as chains of DataFrame functions."""
