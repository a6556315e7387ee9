"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

The statistics of a text are one row of numbers, computed for a slice of texts at
a time. Trees are grown on binned statistics of a bounded labelled sample and then
laid out in flat arrays, so a batch walks all trees together in numpy.

Defined results: a null text counts as empty; an empty text has statistics of zero
and is scored like any other. Repeated rows get equal scores. Without labelled rows,
or with one label only, every score is ``prior``. Other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioworks.llm.columns import keep_rows, with_results
from folioworks.llm.labelled import fit_in_task, held_out, sample
from folioworks.llm.words import Tokens, distinct, mix, ngrams, runs, slices, sorted_keys

#: Labelled texts that reach the driver for the fit, at most.
SAMPLE_ROWS = 6000
TREES, DEPTH, BINS, RATE, LEAST_WEIGHT, SHRINK = 60, 4, 64, 0.15, 4.0, 1.0

_B = np.arange(256)
_UPPER = (_B >= 65) & (_B <= 90)
_LOWER = (_B >= 97) & (_B <= 122)
_DIGIT = (_B >= 48) & (_B <= 57)
_HIGH = _B >= 128
_BLANK = np.isin(_B, [32, 9, 10, 11, 12, 13])
_SENTENCE = np.isin(_B, list(b".?!"))
_MARK = ~(_UPPER | _LOWER | _DIGIT | _HIGH | _BLANK)
_ODD = _MARK & ~np.isin(_B, list(b".,;:'\"-()?"))
_ALPHA = _UPPER | _LOWER | _HIGH

STATISTICS = [
    "log_words", "log_lines", "words_per_line", "upper", "digits", "marks", "odd_marks", "high_bytes", "blanks",
    "word_length", "word_length_spread", "longest_word", "short_words", "capital_words", "words_without_letter",
    "sentence_ends", "odd_ends", "distinct_words", "distinct_triples", "distinct_lines", "top_word",
]


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of STATISTICS per text, over the whole of it."""
    tokens = Tokens(texts, lower=False)
    data, n = tokens.data, len(texts)
    begin = tokens.offsets[:-1]
    size = np.maximum(tokens.lengths, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask[data].view(np.int8), begin, dtype=np.int32).astype(np.int64)

    letters = np.maximum(share(_ALPHA), 1)
    words = np.diff(tokens.first)
    some = np.maximum(words, 1)
    length = (tokens.end - tokens.start).astype(float)

    def per_word(values: np.ndarray) -> np.ndarray:
        return np.bincount(tokens.doc, weights=values, minlength=n) / some

    heads, tails = data[tokens.start], data[tokens.end - 1]
    alpha = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_ALPHA[data], out=alpha[1:])
    mean = per_word(length)
    longest = np.zeros(n)
    np.maximum.at(longest, tokens.doc, length)

    hashes = tokens.hashes()
    _, of, times = runs(sorted_keys(hashes, tokens.doc))
    top = np.zeros(n)
    np.maximum.at(top, of, times.astype(float))
    triples, of3 = ngrams(hashes, tokens.doc, tokens.first, 3)
    _, once3_of = distinct(triples, of3)
    n3 = np.maximum(np.bincount(of3, minlength=n), 1)

    ends = np.flatnonzero(data == 10)  # every text has one more line break, added at its end
    starts = np.r_[0, ends[:-1] + 1]
    line_doc = np.searchsorted(tokens.offsets, starts, side="right") - 1
    filled = ends > starts
    first_word, last_word = np.searchsorted(tokens.start, starts), np.searchsorted(tokens.start, ends)
    run = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes, out=run[1:])
    key = mix(run[last_word] - run[first_word])
    lines = np.bincount(line_doc[filled], minlength=n)
    once_line, line_of = distinct(key[filled], line_doc[filled])

    columns = [
        np.log1p(words), np.log1p(lines), words / np.maximum(lines, 1), share(_UPPER) / letters, share(_DIGIT) / size,
        share(_MARK) / size, share(_ODD) / size, share(_HIGH) / size, (share(_BLANK) - 1) / size,
        mean, np.sqrt(np.maximum(per_word(length * length) - mean * mean, 0)), np.log1p(longest), per_word(length <= 3),
        per_word(_UPPER[heads]), per_word(alpha[tokens.end] == alpha[tokens.start]),
        per_word(_SENTENCE[tails]), per_word(_ODD[tails]), np.bincount(of, minlength=n) / some,
        np.bincount(once3_of, minlength=n) / n3, np.bincount(line_of, minlength=n) / np.maximum(lines, 1), top / some,
    ]
    return np.column_stack(columns).astype(np.float64)


@dataclass(frozen=True)
class Trees:
    """All trees in flat arrays: a node's statistic, limit and children; a leaf leads to itself."""

    roots: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float

    def margin(self, rows: np.ndarray) -> np.ndarray:
        node = np.tile(self.roots, (len(rows), 1))
        each = np.arange(len(rows))[:, None]
        for _ in range(DEPTH):
            below = rows[each, self.feature[node]] <= self.limit[node]
            node = np.where(below, self.left[node], self.right[node])
        return self.start + self.value[node].sum(axis=1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -30, 30)))


def constant(prior: float) -> Trees:
    none = np.zeros(0, dtype=np.int64)
    return Trees(none, none, np.zeros(0), none, none, np.zeros(0), float(np.log(prior / (1 - prior))))


def grow(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Boost ``TREES`` trees on binned rows under the logistic loss; classes weigh alike."""
    n, width = rows.shape
    limits = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.column_stack([np.searchsorted(limits[f], rows[:, f], side="left") for f in range(width)])
    least = min(LEAST_WEIGHT, 0.01 * n)
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    margin = np.zeros(n)
    roots, feature, limit, left, right, value = [], [], [], [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = weight * (p - labels), weight * p * (1 - p)
        at = np.zeros(n, dtype=np.int64)  # position of each row's node among this level's nodes
        roots.append(len(feature))
        level, step = [len(feature)], np.zeros(n)
        for arrays in (feature, left, right):
            arrays.append(0)
        limit.append(np.inf), value.append(0.0)
        alive = np.ones(n, dtype=bool)
        for depth in range(DEPTH + 1):
            k = len(level)
            g = np.bincount(at[alive], weights=slope[alive], minlength=k)
            h = np.bincount(at[alive], weights=bend[alive], minlength=k)
            best, choice = np.full(k, 1e-6), [None] * k
            if depth < DEPTH:
                for f in range(width):
                    b = len(limits[f]) + 1
                    cell = at[alive] * b + binned[alive, f]
                    gl = np.bincount(cell, weights=slope[alive], minlength=k * b).reshape(k, b).cumsum(1)[:, :-1]
                    hl = np.bincount(cell, weights=bend[alive], minlength=k * b).reshape(k, b).cumsum(1)[:, :-1]
                    if not gl.shape[1]:
                        continue
                    gr, hr = g[:, None] - gl, h[:, None] - hl
                    gain = gl**2 / (hl + SHRINK) + gr**2 / (hr + SHRINK) - (g**2 / (h + SHRINK))[:, None]
                    gain[(hl < least) | (hr < least)] = -1
                    where = gain.argmax(1)
                    for i in range(k):
                        if gain[i, where[i]] > best[i]:
                            best[i], choice[i] = gain[i, where[i]], (f, where[i])
            following, moved = [], np.full(n, -1)
            for i, node in enumerate(level):
                mine = alive & (at == i)
                if choice[i] is None:
                    value[node] = -RATE * g[i] / (h[i] + SHRINK)
                    left[node] = right[node] = node
                    step[mine] = value[node]
                    continue
                f, cut = choice[i]
                feature[node], limit[node] = f, limits[f][cut]
                left[node], right[node] = len(feature), len(feature) + 1
                goes_left = binned[:, f] <= cut
                moved[mine & goes_left], moved[mine & ~goes_left] = len(following), len(following) + 1
                following += [len(feature), len(feature) + 1]
                for _ in range(2):
                    feature.append(0), limit.append(np.inf), left.append(0), right.append(0), value.append(0.0)
            alive &= moved >= 0
            at, level = np.where(moved >= 0, moved, 0), following
            if not level:
                break
        margin += step
    as_int = lambda x: np.asarray(x, dtype=np.int64)
    return Trees(as_int(roots), as_int(feature), np.asarray(limit), as_int(left), as_int(right), np.asarray(value), 0.0)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, prior: float = 0.9) -> Trees:
    """Trees for ``labels.quality``, from at most ``rows`` labelled texts that are not held out."""

    def learned(texts: list[str], marks: np.ndarray) -> Trees:
        if len(set(marks.tolist())) < 2:
            return constant(prior)
        parts = [statistics(part) for _, part in slices(pa.array(texts))]
        return grow(np.concatenate(parts), marks.astype(float))

    return fit_in_task(sample(docs, labels, "quality", rows), learned)


def scorer(trees: Trees):
    def scores(texts: pa.Array) -> np.ndarray:
        parts = [trees.score(statistics(part)) for _, part in slices(texts)]
        return np.concatenate(parts) if parts else np.zeros(0)

    return scores


RESULTS = T.StructType([T.StructField("score", T.DoubleType())])


def score_quality(docs: DataFrame, trees: Trees, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and ``score``, the probability that a text is good, one row per row of ``docs``."""
    return with_results(docs, list(keys), RESULTS, lambda: lambda texts, f=scorer(trees): [pa.array(f(texts))])


def keep_good(docs: DataFrame, trees: Trees, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score ``threshold`` or more, with all their columns."""
    return keep_rows(docs, lambda: lambda texts, f=scorer(trees): f(texts) >= threshold)


def op5_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    trees = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_quality(docs, trees)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
