"""Data sets and reports assembled from the operators."""
