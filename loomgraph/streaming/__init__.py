"""Loomgraph streaming."""
