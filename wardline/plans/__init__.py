"""Whole jobs and datasets composed from the operators."""
