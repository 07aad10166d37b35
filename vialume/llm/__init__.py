"""Operators of a training-data pipeline, with their queries and SQL.

Nothing outside this subpackage imports it; only the driver contract adds its queries.
"""

from importlib import import_module

MODULES = (
    "line_dedup", "sharding", "jaccard_join", "quality_rules", "license_scan",
    "url_filter", "multi_index", "byte_bpe", "quality_classifier", "packing", "centroids", "substring_dedup", "prefix_trie",
)


def llm_queries() -> dict:
    """Name of each query -> (function of session and folder, SQL or None)."""
    found = {}
    for name in MODULES:
        module = import_module(f"vialume.llm.{name}")
        found[module.QUERY] = (module.run, module.SQL)
    return found
