"""Loomgraph operators."""
