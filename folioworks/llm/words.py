"""Texts as numpy arrays: tokens of a batch as offsets and 64-bit hashes.

Everything here works on one Arrow batch inside a task. Large batches are cut
into slices of whole texts, so memory follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20
#: Texts of a slice, at most; their numbers share an integer with a hash.
SLICE_TEXTS = 4000
#: ASCII white space: space, tab, line feed, vertical tab, form feed, return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0xD6E8FEB86659FD93
_powers: dict[str, np.ndarray] = {}
#: As many as a slice of texts, with the breaks between them, asks for.
SLICE_POWERS = SLICE_BYTES + 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every input bit reaches every output bit."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base modulo 2**64, and of its inverse.

    A Python worker keeps those for a slice; for a longer text they are made anew.
    """

    def made(base: int, size: int) -> np.ndarray:
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps, out=steps)

    if n > SLICE_POWERS:
        return made(_BASE, n), made(pow(_BASE, -1, 1 << 64), n)
    if not _powers:
        _powers.update(up=made(_BASE, SLICE_POWERS), down=made(pow(_BASE, -1, 1 << 64), SLICE_POWERS))
    return _powers["up"][:n], _powers["down"][:n]


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive rows as UTF-8 bytes (null: empty), with the number of the first row."""
    values = texts.cast(pa.binary())
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(values), 0), dtype=np.int64)
    first, held = 0, 0
    for i, n in enumerate(lengths):
        if held and (held + n > size or i - first >= SLICE_TEXTS):
            yield first, [x or b"" for x in values.slice(first, i - first).to_pylist()]
            first, held = i, 0
        held += int(n) + 1
    if first < len(lengths):
        yield first, [x or b"" for x in values.slice(first).to_pylist()]


class Tokens:
    """White-space separated words of some texts, in order.

    ``start`` and ``end`` are offsets into ``data``, ``doc`` the number of the text,
    ``first`` the number of each text's first word (one more entry than texts).
    """

    def __init__(self, texts: list[bytes], lower: bool = True):
        joined = b"\n".join(texts) + b"\n"
        self.data = np.frombuffer(joined.lower() if lower else joined, dtype=np.uint8)
        self.lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.offsets = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum(self.lengths + 1, out=self.offsets[1:])
        inside = np.zeros(len(self.data) + 2, dtype=np.int8)
        inside[1:-1] = ~SPACE[self.data]
        edges = np.flatnonzero(np.diff(inside))
        self.start, self.end = edges[::2], edges[1::2]
        self.first = np.searchsorted(self.start, self.offsets)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, alike in every process."""
        up, down = powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.data] * up[:-1], out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))


def ngrams(hashes: np.ndarray, doc: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside a text, and their text numbers.

    A text of fewer words, but one at least, has one run: all its words.
    """
    rolled = mix(hashes)
    for k in range(1, n):
        rolled[:-k] = mix(rolled[:-k] * _M1 + hashes[k:]) if k < len(hashes) else rolled[:-k]
    words = np.diff(first)
    place = np.arange(len(hashes)) - first[doc]
    whole = place + n <= words[doc]
    grams, of = rolled[whole], doc[whole]
    short = np.flatnonzero((words > 0) & (words < n))
    if len(short):
        lone = []
        for d in short:
            x = mix(hashes[first[d] : first[d] + 1])
            for k in range(1, words[d]):
                x = mix(x * _M1 + hashes[first[d] + k : first[d] + k + 1])
            lone.append(mix(x + np.uint64(words[d])))
        grams, of = np.concatenate([grams, *lone]), np.concatenate([of, short])
    return grams, of


#: Bits of a hash that are kept beside the text number when the tokens of a slice are sorted.
HASH_BITS = np.uint64(52)
_LOW = np.uint64((1 << 52) - 1)


def sorted_keys(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Text number and the upper 52 bits of each hash in one sorted integer; at most 4096 texts."""
    return np.sort((doc.astype(np.uint64) << HASH_BITS) | (hashes >> np.uint64(12)))


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of sorted keys as 52-bit hashes, their text numbers and their counts."""
    edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    once = keys[edge]
    return once & _LOW, (once >> HASH_BITS).astype(np.int64), np.diff(np.r_[edge, len(keys)])


def distinct(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each hash (52 bits of it) once per text, by text and value."""
    return runs(sorted_keys(hashes, doc))[:2]


def row_batches(batches: Iterable[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
