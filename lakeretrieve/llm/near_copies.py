"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

SimHash fingerprints at three bits miss almost all pairs of that similarity, so
the pairs come from the Jaccard join of :mod:`ngram_join`, which finds every one.

Defined cases: a null text counts as empty; texts without words are copies of each
other. A text of fewer words than a shingle is one shingle. Rows with equal ids are separate rows.
"""

from __future__ import annotations

from lakeretrieve.llm.ngram_join import keep_one

__all__ = ["keep_one"]
