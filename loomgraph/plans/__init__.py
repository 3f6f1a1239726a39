"""Loomgraph plans."""
