"""Loomgraph functions."""
