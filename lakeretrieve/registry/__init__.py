"""Named queries over the given tables, each with its SQL counterpart.

Importing this package fills :data:`QUERIES` and :data:`ORACLES`.
"""

from lakeretrieve.registry.base import ORACLES, QUERIES, Tables
from lakeretrieve.registry import (  # noqa: F401  (imported for their entries)
    blobs,
    chat,
    fulltext,
    hybrid,
    keyed,
    rag,
    sqlsurface,
    streams,
    vectors,
)

__all__ = ["ORACLES", "QUERIES", "Tables"]
