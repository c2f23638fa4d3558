"""Token ids of whole texts, with a memory of chunks between white space.

A tokenizer works on pieces of text that never reach across white space, nor from a
letter to a mark, so a text's ids are those of its chunks put together, and most chunks
have been seen before. The memory is bounded: when it is full it becomes the older
memory, and what was older is forgotten unless it was asked for again. A text
for which chunks could differ from the whole is given to the tokenizer whole.

Texts come in blocks. The chunks of a block are numbered by Arrow, each different
one is looked up once, those not remembered are tokenized together with a special
token between them, and the texts' ids are gathered by number.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Chunks remembered by a Python worker before the older ones are let go, and the longest chunk that is.
MOST_CHUNKS = 450_000
LONGEST_CHUNK = 64
# Characters of a block of texts (a longer text is a block of its own), and chunks tokenized together.
# A block takes about thirty bytes a character beside the memory, and all workers of an executor have one.
BLOCK_CHARS = 1_000_000
TOGETHER = 64

# Stands between chunks; no text that is cut into chunks has it.
_CUT = "\x1c"
# What the tokenizers' own patterns and Python may see differently, or special tokens begin with.
_ODD = ("<|", _CUT, "\x1d", "\x1e", "\x1f")
# A white-space run that goes on beyond a single space between chunks.
_LONG_GAP = re.compile(r"\s (?:\s|\Z)")
# A Latin letter with a mark after it: every tokenizer here splits them.
_MARKED = "([A-Za-zÀ-ÖØ-öø-įı-ɏ])([.,!?;:*#$%&|])"
_CHUNK = re.compile(r" ?\S+|\s+(?!\S)|\s+")


def _bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class Encoder:
    """``encode(text)`` gives the ids of a text as little-endian unsigned 32-bit numbers, ``encode_all`` those of many."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # Whether white space has ids of its own, and whether letters of either case have the same.
        self.keeps_space = self._alone("a  b") != self._alone("a b")
        self.any_case = self._alone("aB") == self._alone("ab")
        self.between = next(t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special)
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        block: list[str] = []
        chars = 0
        for text in texts:
            if block and chars + len(text) > BLOCK_CHARS:
                yield from self._block(block)
                block, chars = [], 0
            block.append(text)
            chars += len(text)
        yield from self._block(block)

    def _block(self, texts: list[str]) -> Iterator[bytes]:
        odd = [any(mark in text for mark in _ODD) for text in texts]
        gap = [not o and self.keeps_space and _LONG_GAP.search(t) is not None for t, o in zip(texts, odd)]
        gathered = iter(self._gathered([t for t, o, g in zip(texts, odd, gap) if not (o or g)]))
        for text, o, g in zip(texts, odd, gap):
            yield self._alone(text) if o else b"".join(self._known(_CHUNK.findall(text))) if g else next(gathered)

    def _gathered(self, texts: list[str]) -> list[bytes]:
        """Ids of texts whose chunks lie between single spaces."""
        if not texts:
            return []
        held = pa.array(texts, pa.large_string())
        if self.any_case:
            held = pc.ascii_lower(held)
        if not self.keeps_space:
            held = pc.replace_substring(held, "\n", " ")
        # A space stays with the chunk after it where it has ids.
        held = pc.replace_substring(held, " ", _CUT + " " if self.keeps_space else _CUT)
        chunks = pc.split_pattern(pc.replace_substring_regex(held, _MARKED, rf"\1{_CUT}\2"), _CUT)
        numbered = chunks.flatten().dictionary_encode()
        numbers = numbered.indices.to_numpy()
        known = self._known(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(known), "<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        counts = sizes[numbers]
        ends = np.concatenate(([0], np.cumsum(counts)))
        places = np.repeat((np.cumsum(sizes) - sizes)[numbers] - ends[:-1], counts) + np.arange(ends[-1])
        raw, bounds = flat[places].tobytes(), (4 * ends[chunks.offsets.to_numpy()]).tolist()
        del held, chunks, numbered, numbers, known, flat, sizes, counts, ends, places
        pa.default_memory_pool().release_unused()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def _known(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk, remembered or made."""
        found = list(map(self.recent.get, chunks))
        missing = [i for i, ids in enumerate(found) if ids is None]
        for i in missing:
            found[i] = self.older.get(chunks[i])
        fresh = list(dict.fromkeys(chunks[i] for i in missing if found[i] is None))
        made: dict[str, bytes] = {}
        for at in range(0, len(fresh), TOGETHER):
            made.update(zip(fresh[at : at + TOGETHER], self._together(fresh[at : at + TOGETHER])))
        for i in missing:
            chunk = chunks[i]
            ids = found[i] = made[chunk] if found[i] is None else found[i]
            if len(chunk) <= LONGEST_CHUNK:
                if len(self.recent) >= MOST_CHUNKS:
                    self.recent, self.older = {}, self.recent
                self.recent[chunk] = ids
        return found

    def _together(self, chunks: list[str]) -> list[bytes]:
        joined = self.tokenizer.encode_batch_fast([self.between.join(chunks)], add_special_tokens=False)[0].ids
        ids = np.array(joined, "<u4")
        cuts = np.flatnonzero(ids == self.tokenizer.token_to_id(self.between))
        if len(cuts) != len(chunks) - 1:
            return [self._alone(chunk) for chunk in chunks]
        raw = ids.tobytes()
        bounds = (4 * cuts).tolist()
        return [raw[a:b] for a, b in zip([0, *(b + 4 for b in bounds)], [*bounds, len(raw)])]

    def _alone(self, text: str) -> bytes:
        return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)


def few_at_once(texts: pa.Array, rows: int = 256) -> Iterator[str]:
    """The texts of a column as strings, so many rows of it at a time."""
    for at in range(0, len(texts), rows):
        yield from texts.slice(at, rows).to_pylist()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary file."""
    return Encoder(path)
