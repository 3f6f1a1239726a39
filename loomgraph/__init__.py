"""Loomgraph: a Spark-first engine for provenance-aware knowledge graphs.

Every operator is ``f(DataFrame..., parameters) -> DataFrame``. The subpackage
``llm`` builds on this package; nothing here imports it.
"""

__version__ = "0.1.0"
