"""Benchmark decontamination: a BM25 index of test items, searched by every passage of every text.

Items are cut into units of at most ``STEP`` words, so that every unit lies whole in one
of a text's passages (``PASSAGE`` words, a new one every ``STEP``). A passage is a query of
its distinct words. Impacts are divided by the score that a unit gives itself; a unit found
word for word scores 1, and all units at or above ``threshold`` are retrieved:

* words are numbered by their greatest impact; of a passage's words, the longest run from
  the low end that adds up to less than a fixed part of the threshold can't lift a unit over
  it (the pivot rule of WAND), so only the other words open posting blocks;
* a block of units is scored only if the block maxima of these words, plus the sum of the
  rest, reach the threshold (block-max WAND). Both bounds are exact: nothing above the
  threshold is lost.

All passages of a slice of texts go through each step together. A retrieved item is then
held against the whole text: the shares of the three-word runs of its question and of its
answer (the last sentence) that the text has must both reach ``overlap``.

The index is bounded: items are taken in as many blocks as keep each below ``INDEX_BYTES``
of text, and the texts are read once for each block.

Defined results: null and empty texts have no passages; null and empty items are never
found; an item of one sentence is question and answer in one; repeated rows of either table
give repeated links; no item gives no link. Case, ASCII punctuation and white space are not
compared. Other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.llm.columns import keep_rows
from folioworks.llm.words import Tokens, mix, ngrams, row_batches, slices

STEP, PASSAGE = 64, 128
THRESHOLD, OVERLAP = 0.6, 0.7
#: Part of the threshold that a passage's lowest words, left out of the block bounds, may add up to.
SLACK = 0.1
K1, B = 1.2, 0.75
#: Units of one posting block.
BLOCK = 8
#: Text bytes of the items of one index, at most.
INDEX_BYTES = 32 << 20
#: Passages times blocks whose bounds are held at once.
BOUND_CELLS = 1 << 22

_PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def plain(texts: list[bytes]) -> list[bytes]:
    """ASCII punctuation as spaces."""
    return [x.translate(_PLAIN) for x in texts]


def _runs(texts: list[bytes], n: int = 3) -> list[np.ndarray]:
    tokens = Tokens(texts)
    grams, of = ngrams(tokens.hashes(), tokens.doc, tokens.first, n)
    order = np.argsort(of, kind="stable")
    return np.split(grams[order], np.cumsum(np.bincount(of, minlength=len(texts)))[:-1])


def question_and_answer(text: str) -> tuple[str, str]:
    """All sentences but the last, and the last; one sentence is both."""
    parts = [p for p in _SENTENCE.split(text) if p.strip()]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, text)


@dataclass(frozen=True)
class Index:
    """Postings of the words of all units, by block, with impacts relative to the unit's own score."""

    item_ids: list
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    unit_item: np.ndarray
    vocabulary: np.ndarray  # sorted hashes
    term: np.ndarray  # number of each vocabulary entry, by greatest impact
    greatest: np.ndarray  # of each term, ascending
    first: np.ndarray  # of each term, its first posting block
    block: np.ndarray
    block_max: np.ndarray
    impacts: np.ndarray  # of each posting block, the impacts of its units
    blocks: int
    present: np.ndarray  # by the upper 20 bits of a hash: may it be in the vocabulary


def build_index(items: list[tuple[object, str]]) -> Index | None:
    items = [(i, t) for i, t in items if t and t.strip()]
    texts = plain([t.encode() for _, t in items])
    tokens = Tokens(texts)
    if not len(tokens.start):
        return None
    hashes = tokens.hashes()
    place = np.arange(len(hashes)) - tokens.first[tokens.doc]
    unit_key = tokens.doc * (1 << 32) + place // STEP
    units, unit = np.unique(unit_key, return_inverse=True)
    vocabulary, word = np.unique(hashes, return_inverse=True)
    pair, times = np.unique(word.astype(np.int64) * len(units) + unit, return_counts=True)
    word, unit_of = pair // len(units), pair % len(units)
    length = np.bincount(unit, minlength=len(units)).astype(float)
    spread = np.bincount(word, minlength=len(vocabulary))
    idf = np.log(1 + (len(units) - spread + 0.5) / (spread + 0.5))
    impact = idf[word] * times * (K1 + 1) / (times + K1 * (1 - B + B * length[unit_of] / length.mean()))
    impact /= np.bincount(unit_of, weights=impact, minlength=len(units))[unit_of]
    greatest = np.zeros(len(vocabulary))
    np.maximum.at(greatest, word, impact)
    order = np.argsort(greatest, kind="stable")
    term = np.empty(len(order), dtype=np.int64)
    term[order] = np.arange(len(order))
    blocks = -(-len(units) // BLOCK)
    cell, row = np.unique(term[word] * blocks + unit_of // BLOCK, return_inverse=True)
    impacts = np.zeros((len(cell), BLOCK), dtype=np.float64)
    impacts[row, unit_of % BLOCK] = impact
    present = np.zeros(1 << 20, dtype=bool)
    present[(vocabulary >> np.uint64(44)).astype(np.int64)] = True
    halves = [question_and_answer(t) for _, t in items]
    return Index(
        [i for i, _ in items],
        _runs(plain([q.encode() for q, _ in halves])),
        _runs(plain([a.encode() for _, a in halves])),
        (units >> 32).astype(np.int64), vocabulary, term, greatest[order],
        np.searchsorted(cell // blocks, np.arange(len(order) + 1)), cell % blocks, impacts.max(axis=1), impacts, blocks, present,
    )


def _spread(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions start..stop of each entry in a row, and the number of the entry."""
    size = stop - start
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size), of


def retrieve(index: Index, tokens: Tokens, hashes: np.ndarray, threshold: float) -> list[tuple[int, int, float]]:
    """(text, item, best score) for every item with a unit at or above the threshold."""
    maybe = np.flatnonzero(index.present[(hashes >> np.uint64(44)).astype(np.int64)])
    at = np.minimum(np.searchsorted(index.vocabulary, hashes[maybe]), len(index.vocabulary) - 1)
    known = index.vocabulary[at] == hashes[maybe]
    word, term = maybe[known], index.term[at[known]]
    if not len(word):
        return []
    words = np.diff(tokens.first)
    passages = np.maximum(1, -(-(words - STEP) // STEP))
    base = np.cumsum(passages) - passages
    doc = tokens.doc[word]
    step = (word - tokens.first[doc]) // STEP
    here = step < passages[doc]
    before = step > 0
    passage = np.concatenate([(base[doc] + step)[here], (base[doc] + step - 1)[before]])
    keys = np.sort((passage << 32) | np.concatenate([term[here], term[before]]))
    keys = keys[np.r_[True, keys[1:] != keys[:-1]]]
    passage, term = keys >> 32, keys & 0xFFFFFFFF
    # Sums of the greatest impacts from the low end, inside each passage.
    edge = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    upto = np.cumsum(index.greatest[term])
    begin = upto[edge] - index.greatest[term[edge]]
    stop = np.r_[edge[1:], len(term)]
    slot = np.repeat(np.arange(len(edge)), stop - edge)
    low = upto - begin[slot] < SLACK * threshold
    alive = (upto[stop - 1] - begin) >= threshold - 1e-9
    rest = np.bincount(slot[low], weights=index.greatest[term[low]], minlength=len(edge))
    opens = np.flatnonzero(~low & alive[slot])
    found: dict[tuple[int, int], float] = {}
    group = max(1, BOUND_CELLS // index.blocks)
    for g in range(0, len(edge), group):
        mine = opens[np.searchsorted(slot[opens], g) : np.searchsorted(slot[opens], g + group)]
        if not len(mine):
            continue
        row, of = _spread(index.first[term[mine]], index.first[term[mine] + 1])
        cell = (slot[mine][of] - g) * index.blocks + index.block[row]
        bound = np.bincount(cell, weights=index.block_max[row])
        hit = np.flatnonzero(bound > 0)
        where = hit // index.blocks + g
        good = bound[hit] + rest[where] >= threshold - 1e-9
        where, block = where[good], hit[good] % index.blocks
        # Full scores of the blocks that are left, over all words of their passages.
        entry, of = _spread(edge[where], stop[where])
        wanted = term[entry] * index.blocks + block[of]
        cells = _cells(index)
        r = np.minimum(np.searchsorted(cells, wanted), len(cells) - 1)
        has = cells[r] == wanted
        mine, held = of[has], index.impacts[r[has]]
        score = np.column_stack([np.bincount(mine, weights=held[:, u], minlength=len(where)) for u in range(BLOCK)])
        k, u = np.nonzero(score >= threshold - 1e-9)
        unit = block[k] * BLOCK + u
        text = np.searchsorted(base, passage[edge[where[k]]], side="right") - 1
        for d, i, s in zip(text.tolist(), index.unit_item[unit].tolist(), score[k, u].tolist(), strict=True):
            found[d, i] = max(s, found.get((d, i), 0.0))
    return [(d, i, s) for (d, i), s in sorted(found.items())]


def _cells(index: Index) -> np.ndarray:
    return np.repeat(np.arange(len(index.first) - 1), np.diff(index.first)) * index.blocks + index.block


def links(index: Index, texts: list[bytes], threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[tuple[int, int, float, float, float]]:
    """(text, item, score, question share, answer share) of every confirmed leak."""
    tokens = Tokens(plain(texts))
    hashes = tokens.hashes()
    out, runs_of = [], {}
    for d, i, score in retrieve(index, tokens, hashes, threshold):
        if d not in runs_of:
            mine = hashes[tokens.first[d] : tokens.first[d + 1]]
            runs_of[d] = np.unique(np.concatenate([_grams(mine, n) for n in (1, 2, 3)]))
        have = runs_of[d]
        shares = [float(np.isin(part, have).mean()) if len(part) else 1.0 for part in (index.questions[i], index.answers[i])]
        if min(shares) >= overlap:
            out.append((d, i, score, *shares))
    return out


def _grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Runs of exactly n words, hashed as ``ngrams`` hashes a text of n words or a run of three."""
    if len(hashes) < n:
        return hashes[:0]
    doc = np.zeros(len(hashes), dtype=np.int64)
    grams, _ = ngrams(hashes, doc, np.array([0, len(hashes)]), n)
    return grams if n == 3 else mix(grams + np.uint64(n))


def indexes(benchmark: DataFrame) -> list[Index]:
    """Indexes of all items, each from at most about INDEX_BYTES of text."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // INDEX_BYTES) or 1
    made = []
    for k in range(parts):
        part = benchmark.select("item_id", "text").filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == k)
        made.append(build_index([(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()]))
    return [x for x in made if x is not None]


RESULTS = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double"


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """One row for every text and test item that it holds: ids, BM25 share and both overlaps."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def search(index: Index) -> DataFrame:
        def run(batches):
            for batch in row_batches(batches):
                for first, texts in slices(batch.column(1)):
                    found = links(index, texts, threshold, overlap)
                    if found:
                        d, i, *numbers = zip(*found, strict=True)
                        ids = batch.column(0).take(pa.array([first + x for x in d]))
                        yield pa.RecordBatch.from_arrays(
                            [ids, pa.array([index.item_ids[x] for x in i], pa.int64()), *map(pa.array, numbers)],
                            names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                        )

        return source.mapInArrow(run, RESULTS)

    made = [search(index) for index in indexes(benchmark)]
    return reduce(DataFrame.union, made) if made else docs.sparkSession.createDataFrame([], RESULTS)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """Rows of ``docs`` that hold no test item, with all their columns."""
    for index in indexes(benchmark):

        def decide(index=index):
            def test(texts: pa.Array) -> np.ndarray:
                clean = np.ones(len(texts), dtype=bool)
                for first, part in slices(texts):
                    clean[[first + x[0] for x in links(index, part, threshold, overlap)]] = False
                return clean

            return test

        docs = keep_rows(docs, decide)
    return docs


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
