"""All named queries of this subpackage."""

from lakeretrieve.llm import (  # noqa: F401  (imported for their entries)
    filter_audit,
    importance,
    licenses,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    quality_rules,
    secrets,
    simhash,
    site_quality,
    syncmers,
    token_store,
)
from lakeretrieve.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
