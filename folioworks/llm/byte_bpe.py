"""Byte-level BPE: encode whole texts by a rank file, and decode the ids again.

The pieces of a slice of texts are found together from the classes of their characters,
which is what the pattern of the rank files says: contractions, letters, digits or other
signs with one space before them, and white space. Each distinct piece of a slice is
encoded once: its bytes are folded by the lowest-ranked merge until none is left. Token
ids of texts are then put together by offsets, and decoding concatenates the byte pieces
of the ids. Words seen before are kept per Python worker up to ``CACHE_WORDS``.

This runs in numpy inside Arrow batches. Folding with Spark's higher-order functions over
a literal rank map was measured first and is far beyond the time limit (README).

Defined results: a null text is an empty one, which has no ids and decodes to no bytes.
Special tokens are plain text. Repeated rows get equal results; texts of any length are
encoded whole, long pieces by a heap instead of repeated scans. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from folioworks.llm.columns import with_results
from folioworks.llm.words import mix, powers, slices

#: Encoded words that a Python worker remembers, at most.
CACHE_WORDS = 400_000
#: Pieces of more bytes than this are merged with a heap.
LONG_PIECE = 48
BLANK, LETTER, NUMBER, OTHER = range(4)
#: White space as Unicode has it.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

_state: dict = {}


def _classes() -> np.ndarray:
    """The class of every code point."""
    if "classes" not in _state:
        kind = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), dtype=np.uint8, count=0x110000)
        table[WHITE] = BLANK
        _state["classes"] = table
    return _state["classes"]


class Ranks:
    """A rank file: id of every byte string, and the byte strings of all ids, end to end."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.width = max(self.ids.values()) + 1
        pieces = [b""] * self.width
        for piece, rank in self.ids.items():
            pieces[rank] = piece
        self.first = np.zeros(self.width + 1, dtype=np.int64)
        np.cumsum([len(p) for p in pieces], out=self.first[1:])
        self.bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, piece: bytes) -> bytes:
        """Ids of one piece, four bytes each. Of the words seen, the more recent half stays."""
        known = self.recent.get(piece)
        if known is None:
            known = self.older.get(piece)
            if known is None:
                rank = self.ids.get(piece)
                if rank is not None:
                    merged = [rank]
                else:
                    merged = self._fold(piece) if len(piece) <= LONG_PIECE else self._fold_long(piece)
                known = array("I", merged).tobytes()
            if len(piece) <= LONG_PIECE:
                if len(self.recent) >= CACHE_WORDS // 2:
                    self.older, self.recent = self.recent, {}
                self.recent[piece] = known
        return known

    def _fold(self, piece: bytes) -> list[int]:
        rank_of, none = self.ids.get, self.width
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = [rank_of(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while ranks and (lowest := min(ranks)) < none:
            at = ranks.index(lowest)
            joined = parts[at] + parts.pop(at + 1)
            parts[at] = joined
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of(joined + parts[at + 1], none)
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] + joined, none)
        return [self.ids[p] for p in parts]

    def _fold_long(self, piece: bytes) -> list[int]:
        rank_of = self.ids.get
        n = len(piece)
        end = list(range(1, n + 1))  # of the part that starts here; 0: merged away
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank_of(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                r = rank_of(piece[i : end[stop]])
                if r is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            p = before[i]
            if p >= 0:
                r = rank_of(piece[p:stop])
                if r is not None:
                    heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ids[piece[i : end[i]]])
            i = end[i]
        return out


def ranks(path: str) -> Ranks:
    if path not in _state:
        _state[path] = Ranks(path)
    return _state[path]


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces begin in the code points of some texts, which begin at ``first``."""
    kind = _classes()[points]
    new = np.zeros(len(points), dtype=bool)
    new[1:] = kind[1:] != kind[:-1]
    new[first[first < len(points)]] = True
    opens = np.zeros(len(points) + 1, dtype=bool)
    opens[first] = True
    start = np.flatnonzero(new)
    stop = np.r_[start[1:], len(points)]
    blank = kind[start] == BLANK
    followed = np.zeros(len(start), dtype=bool)
    followed[:-1] = ~opens[stop[:-1]]
    marks = np.zeros(len(points) + 1, dtype=bool)
    marks[start] = True
    # The last of the white space before something else: a space joins it, other signs stand alone.
    tail = stop[blank & followed] - 1
    space = points[tail] == 0x20
    marks[tail] = True
    marks[tail[space] + 1] = False
    # Contractions: an apostrophe that begins a piece, and the letters after it.
    lone = np.flatnonzero((kind[start] == OTHER) & (stop - start == 1) & followed & (points[start] == 0x27))
    lone = lone[marks[start[lone]]]
    lone = lone[kind[start[lone + 1]] == LETTER] if len(lone) else lone
    if len(lone):
        letters = np.r_[points, 0, 0]
        a, b = letters[stop[lone]], letters[stop[lone] + 1]
        two = (stop[lone + 1] - start[lone + 1]) >= 2
        size = np.where(np.isin(a, [ord(c) for c in "stmd"]), 1, 0)
        pair = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        size = np.where(pair & two, 2, size)
        hit = lone[size > 0]
        size = size[size > 0]
        marks[start[hit + 1]] = False
        marks[start[hit + 1] + size] = True
    return np.flatnonzero(marks[:-1])


def encode_texts(table: Ranks, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, end to end, and where each text's ids begin (one entry more)."""
    words = [t.decode("utf-8", "replace") for t in texts]
    joined = "".join(words)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    first = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum([len(w) for w in words], out=first[1:])
    if not len(points):
        return np.zeros(0, dtype=np.uint32), np.zeros(len(words) + 1, dtype=np.int64)
    start = piece_starts(points, first)
    stop = np.r_[start[1:], len(points)]
    up, down = powers(len(points) + 1)
    total = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum(mix(points.astype(np.uint64)) * up[:-1], out=total[1:])
    key = mix((total[stop] - total[start]) * down[start])
    _, place, back = np.unique(key, return_index=True, return_inverse=True)
    encode = table.encode
    made = [encode(joined[a:b].encode()) for a, b in zip(start[place].tolist(), stop[place].tolist(), strict=True)]
    size = np.fromiter(map(len, made), dtype=np.int64, count=len(made)) // 4
    begin = np.cumsum(size) - size
    ids, count = spread(np.frombuffer(b"".join(made), dtype=np.uint32), begin, size, back)
    upto = np.r_[0, np.cumsum(count)]
    return ids, upto[np.searchsorted(start, first)]


def spread(values: np.ndarray, begin: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` named by ``which``, end to end, and their sizes."""
    count = size[which]
    ends = np.cumsum(count)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[which] - (ends - count), count)
    return values[at], count


def decode_ids(table: Ranks, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ids, end to end, and the size of each."""
    return spread(table.bytes, table.first[:-1], np.diff(table.first), ids.astype(np.int64))


FIELDS = {
    "n_tokens": T.LongType(),
    "ids": T.ArrayType(T.IntegerType()),
    "ids_sha256": T.StringType(),
    "decoded": T.StringType(),
    "decoded_sha256": T.StringType(),
}


def tokenize(docs: DataFrame, path: str, keys: list[str], fields: list[str]) -> DataFrame:
    """``keys`` and the chosen FIELDS: number of ids, ids, decoded text and SHA-256 sums of both.

    The sums are over ids as little-endian unsigned 32-bit integers, and over the decoded bytes.
    """
    schema = T.StructType([T.StructField(f, FIELDS[f]) for f in fields])

    def compute():
        table = ranks(path)

        def work(texts: pa.Array) -> list[pa.Array]:
            out: dict[str, list] = {f: [] for f in fields}
            for _, part in slices(texts):
                ids, first = encode_texts(table, part)
                content, size = decode_ids(table, ids)
                upto = np.r_[0, np.cumsum(size)]
                edges, raw = first.tolist(), ids.astype("<u4").view(np.uint8)
                for k in range(len(part)):
                    a, b = edges[k], edges[k + 1]
                    text = memoryview(content[upto[a] : upto[b]])
                    for f in fields:
                        if f == "n_tokens":
                            out[f].append(b - a)
                        elif f == "ids":
                            out[f].append(ids[a:b].astype(np.int32))
                        elif f == "ids_sha256":
                            out[f].append(hashlib.sha256(memoryview(raw[4 * a : 4 * b])).hexdigest())
                        elif f == "decoded":
                            out[f].append(bytes(text).decode())
                        else:
                            out[f].append(hashlib.sha256(text).hexdigest())
            kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
            return [pa.array(out[f], kinds.get(f, pa.string())) for f in fields]

        return work

    return with_results(docs, keys, schema, compute)


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return tokenize(docs, path, ["doc_id"], ["n_tokens", "ids_sha256", "decoded_sha256"])
