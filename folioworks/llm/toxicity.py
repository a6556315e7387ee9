"""Toxicity: a support vector machine under a gapped subsequence kernel, by Nyström landmarks.

A text is a set of sentences and a sentence a set of words. The kernel of two words
sums over common subsequences of three symbols, each weighed by ``DECAY`` for every
symbol that it skips (up to ``GAPS`` - 1 between two neighbours), so an insult with
symbols inserted stays close to the plain one. Punctuation inside words is not a
symbol, and single letters in a row ("i d i o t") are read as one word.

A sentence is as toxic as its worst word. Only texts are labelled: of a toxic text the
sentence with the worst word is the positive one, chosen anew after each fit; all words
of the other texts are negative. Landmarks are picked from both by pivoted Cholesky
steps on the kernel matrix. Since the kernel is a dot product of sparse subsequence
counts, the fitted machine folds into one weight for each triple of symbols, and whole
texts are scored by table look-ups over their distinct words.

Defined results: null and empty texts, and texts without a word of two letters, get the
lowest margin, so a score near 0. Repeated rows get equal scores. Without labelled rows,
or with one label only, every score is ``prior``. No text is cut.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioworks.llm.columns import keep_rows, with_results
from folioworks.llm.labelled import fit_in_task, held_out, sample, without_copies
from folioworks.llm.words import SPACE, mix, slices

#: Labelled texts that reach the driver for the fit, at most.
SAMPLE_ROWS = 3000
DECAY, GAPS = 0.5, 3
LANDMARKS, ROUNDS, COST = 320, 3, 30.0
#: Examples of each toxic word with a strange symbol put in.
BENT = 4
SYMBOLS = 64
START = SYMBOLS - 1
#: The margin of a text without words.
NOTHING = -2.0
#: Runs of symbols of consecutive texts that are counted at once; one longer text is counted by itself.
EVIDENCE_STEP = 500_000


def _symbols() -> np.ndarray:
    """Byte to symbol: letters, digits and the second bytes of accented letters; 0: not a symbol."""
    table = np.zeros(256, dtype=np.uint8)
    table[97:123] = np.arange(1, 27)
    table[48:58] = np.arange(27, 37)
    high = np.arange(0x80, 0xC0)
    table[high] = 37 + high % 26
    table[0xE0:] = 37 + np.arange(0xE0, 0x100) % 26
    table[SPACE] = START
    return table


SYMBOL = _symbols()
SHAPES = [(a, b, DECAY ** (a + b - 2)) for a in range(1, GAPS + 1) for b in range(1, GAPS + 1)]


class Words:
    """Words of some texts as runs of symbols; ``start`` is the break before a word."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer((b"\n" + b"\n".join(texts) + b"\n").lower(), dtype=np.uint8)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        offsets = np.concatenate([[0], np.cumsum(lengths + 1)])
        symbols = SYMBOL[data]
        kept = np.flatnonzero(symbols)
        stream = symbols[kept]
        start, end = self._spans(stream)
        doc = np.searchsorted(offsets, kept[start], side="right") - 1
        single = (end - start) == 1
        joined = np.flatnonzero(single[:-1] & single[1:] & (doc[:-1] == doc[1:]))
        if len(joined):
            change = np.zeros(len(stream) + 1, dtype=np.int64)
            np.add.at(change, end[joined], 1)
            np.add.at(change, start[joined + 1], -1)
            stays = np.cumsum(change[:-1]) == 0
            stream, kept = stream[stays], kept[stays]
            start, end = self._spans(stream)
            doc = np.searchsorted(offsets, kept[start], side="right") - 1
        whole = end - start >= 2
        self.stream, self.start, self.end, self.doc = stream, start[whole] - 1, end[whole], doc[whole]
        self.count = len(texts)

    @staticmethod
    def _spans(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inside = np.zeros(len(stream) + 1, dtype=np.int8)
        inside[:-1] = stream != START
        edges = np.flatnonzero(np.diff(inside)) + 1
        return edges[::2], edges[1::2]

    def keys(self) -> np.ndarray:
        """One integer per word, equal for equal words."""
        from folioworks.llm.words import powers

        up, down = powers(len(self.stream) + 1)
        total = np.zeros(len(self.stream) + 1, dtype=np.uint64)
        np.cumsum(mix(self.stream.astype(np.uint64)) * up[:-1], out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start])

    def features(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the words ``which``: (place in which, triple, weight) of every subsequence."""
        begin, stop = self.start[which], self.end[which]
        size = stop - begin
        of = np.repeat(np.arange(len(which)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
        last = np.repeat(stop, size)
        s = self.stream.astype(np.int32)
        places, triples, weights = [], [], []
        for a, b, weight in SHAPES:
            fits = at + (a + b) < last
            p = at[fits]
            places.append(of[fits])
            triples.append((s[p] * SYMBOLS + s[p + a]) * SYMBOLS + s[p + a + b])
            weights.append(np.full(len(p), weight))
        return np.concatenate(places), np.concatenate(triples), np.concatenate(weights)

    def picked(self, which: np.ndarray, more: list[np.ndarray] = ()) -> Words:
        """The words ``which``, and others given as symbols, by themselves."""
        size = (self.end - self.start)[which]
        at = np.arange(size.sum()) + np.repeat(self.start[which] - (np.cumsum(size) - size), size)
        size = np.concatenate([size, np.fromiter(map(len, more), dtype=np.int64, count=len(more))])
        made = Words([])
        made.stream = np.concatenate([self.stream[at], *more, np.full(1, START, dtype=np.uint8)])
        made.start, made.end = np.cumsum(size) - size, np.cumsum(size)
        made.doc, made.count = np.arange(len(size)), len(size)
        return made

    def bent(self, which: np.ndarray, rng: np.random.Generator) -> list[np.ndarray]:
        """Of the words ``which`` with four symbols or more, the symbols with one strange one put in."""
        which = which[(self.end - self.start)[which] > 4]
        words = [self.stream[a:b] for a, b in zip(self.start[which].tolist(), self.end[which].tolist(), strict=True)]
        return [np.insert(w, rng.integers(2, len(w)), rng.integers(1, 37)).astype(np.uint8) for w in words]

    def norms(self, which: np.ndarray) -> np.ndarray:
        size = (self.end - self.start)[which].astype(float)
        total = sum(np.maximum(size - (a + b), 0) * weight * weight for a, b, weight in SHAPES)
        return np.sqrt(np.maximum(total, 1e-9))

    def project(self, which: np.ndarray, table: np.ndarray, step: int = 50_000) -> np.ndarray:
        """Dot product of each word's unit vector with ``table``."""
        if len(which) > step:
            return np.concatenate([self.project(which[i : i + step], table) for i in range(0, len(which), step)])
        begin, stop = self.start[which], self.end[which]
        size = stop - begin
        of = np.repeat(np.arange(len(which)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
        last = np.repeat(stop, size)
        s = np.concatenate([self.stream, np.zeros(2 * GAPS, dtype=np.uint8)]).astype(np.int32)
        total = np.zeros(len(at))
        for a, b, weight in SHAPES:
            value = table[(s[at] * SYMBOLS + s[at + a]) * SYMBOLS + s[at + a + b]]
            total += np.where(at + (a + b) < last, value, 0) * weight
        return np.bincount(of, weights=total, minlength=len(which)) / self.norms(which)


def vocabulary(texts: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray]:
    """The distinct words of all texts, by key, and each (text, word) once, by text: their numbers.

    The texts are read a slice at a time, so memory follows the words, not the texts.
    """
    held, docs, words = [], [], []
    for first, part in slices(pa.array(texts, pa.binary())):
        some = Words(part)
        keys, place, back = np.unique(some.keys(), return_index=True, return_inverse=True)
        pair = np.unique(some.doc.astype(np.int64) * len(keys) + back)
        # Without a word there is no pair, and nothing is divided.
        held.append((keys, some.picked(place)))
        docs.append(pair // max(len(keys), 1) + first)
        words.append(keys[pair % max(len(keys), 1)])
    if not held:
        return Words([]), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    upto = np.cumsum([0, *[len(w.stream) for _, w in held]])
    joined = Words([])
    joined.stream = np.concatenate([w.stream for _, w in held])
    joined.start = np.concatenate([w.start + a for (_, w), a in zip(held, upto, strict=False)])
    joined.end = np.concatenate([w.end + a for (_, w), a in zip(held, upto, strict=False)])
    keys, place = np.unique(np.concatenate([k for k, _ in held]), return_index=True)
    return joined.picked(place), np.concatenate(docs), np.searchsorted(keys, np.concatenate(words))


@dataclass(frozen=True)
class Machine:
    """The fitted machine: a weight per triple of symbols, and the slope and offset of its probability."""

    table: np.ndarray
    bias: float
    slope: float
    offset: float
    prior: float | None = None

    def margins(self, texts: list[bytes]) -> np.ndarray:
        words = Words(texts)
        _, place, back = np.unique(words.keys(), return_index=True, return_inverse=True)
        value = words.project(place, self.table) + self.bias
        out = np.full(len(texts), NOTHING)
        np.maximum.at(out, words.doc, value[back])
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.offset, -30, 30)))


class Kernel:
    """Kernel columns of a few thousand words, from their subsequences."""

    def __init__(self, words: Words):
        self.count = len(words.start)
        self.of, self.triple, self.weight = words.features(np.arange(self.count))
        self.weight = self.weight / words.norms(np.arange(self.count))[self.of]
        order = np.argsort(self.of, kind="stable")
        self.of, self.triple, self.weight = self.of[order], self.triple[order], self.weight[order]
        self.first = np.searchsorted(self.of, np.arange(self.count + 1))

    def vector(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        mine = slice(self.first[i], self.first[i + 1])
        return self.triple[mine], self.weight[mine]

    def column(self, i: int, table: np.ndarray) -> np.ndarray:
        """Kernel of word ``i`` with all words; ``table`` is zero before and after."""
        triple, weight = self.vector(i)
        np.add.at(table, triple, weight)
        out = np.bincount(self.of, weights=table[self.triple] * self.weight, minlength=self.count)
        table[triple] = 0
        return out

    def landmarks(self, candidates: np.ndarray, scale: np.ndarray, count: int) -> tuple[list[int], list[np.ndarray]]:
        """At most ``count`` of ``candidates`` by pivoted Cholesky steps on their scaled kernel, with their columns."""
        table = np.zeros(SYMBOLS**3)
        left = np.full(len(candidates), -1.0)
        own = np.bincount(self.of, minlength=self.count) > 0
        left[own[candidates]] = 1.0
        left *= scale**2
        basis, picked, columns = np.zeros((len(candidates), count)), [], []
        for k in range(min(count, len(candidates))):
            i = int(left.argmax())
            if left[i] < 1e-3:
                break
            column = self.column(candidates[i], table)
            scaled = column[candidates] * scale * scale[i]
            picked.append(int(candidates[i]))
            columns.append(column)
            basis[:, k] = (scaled - basis[:, :k] @ basis[i, :k]) / np.sqrt(left[i])
            left = left - basis[:, k] ** 2
            left[i] = -1
        return picked, columns


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    x = np.column_stack([z, np.ones(len(z))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(30):
        inside = y * (x @ w) < 1
        xs, c = x[inside], COST * weight[inside]
        new = np.linalg.solve(ridge + (xs * c[:, None]).T @ xs, (xs * c[:, None]).T @ y[inside])
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w[:-1], float(w[-1])


def _evidence(words: Words, doc: np.ndarray, word: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """A first rank of the distinct words: how far a run of four of their symbols, or all of
    them, is commoner among toxic texts than among the others. ``word`` is in the text ``doc``."""
    size = words.end - words.start
    n = len(size)
    of = np.repeat(np.arange(n), np.maximum(size - 3, 0))
    counts = np.bincount(of, minlength=n)
    at = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + words.start[of]
    s = words.stream.astype(np.int64)
    gram = ((s[at] * SYMBOLS + s[at + 1]) * SYMBOLS + s[at + 2]) * SYMBOLS + s[at + 3]
    _, gram = np.unique(gram, return_inverse=True)
    kinds = int(gram.max(initial=-1)) + 1
    gram, of = np.concatenate([gram, kinds + np.arange(n)]), np.concatenate([of, np.arange(n)])
    kinds += n
    order = np.argsort(of, kind="stable")
    gram, first = gram[order], np.searchsorted(of[order], np.arange(n + 1))
    hot, cold = np.zeros(kinds, dtype=np.int64), np.zeros(kinds, dtype=np.int64)
    begin = np.searchsorted(doc, np.arange(len(labels) + 1))
    upto = np.concatenate([[0], np.cumsum(np.diff(first)[word])])[begin]
    a = 0
    while a < len(labels):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + EVIDENCE_STEP, side="right")) - 1)
        mine = slice(begin[a], begin[b])
        counts = np.diff(first)[word[mine]]
        spread = np.arange(counts.sum()) + np.repeat(first[word[mine]] - (np.cumsum(counts) - counts), counts)
        seen = np.unique(np.repeat(doc[mine] - a, counts) * kinds + gram[spread])
        seen_toxic = labels[a + seen // kinds] == 1
        hot += np.bincount(seen[seen_toxic] % kinds, minlength=kinds)
        cold += np.bincount(seen[~seen_toxic] % kinds, minlength=kinds)
        a = b
    ratio = (hot + 0.5) / max((labels == 1).sum(), 1) / ((cold + 0.5) / max((labels == 0).sum(), 1))
    weight = hot * np.log(ratio)
    value = np.full(n, -np.inf)
    np.maximum.at(value, np.repeat(np.arange(n), np.diff(first)), weight[gram])
    return value


def learn(texts: list[str], labels: np.ndarray) -> Machine:
    """Fit the machine on labelled texts; of near copies the first counts."""
    kept = without_copies(texts)
    texts, labels = [texts[i].encode() for i in kept], labels[kept]
    words, doc, word = vocabulary(texts)
    every = np.arange(len(words.start))
    toxic = labels[doc] == 1
    clean_words = np.zeros(len(every), dtype=bool)
    clean_words[word[~toxic]] = True
    value = _evidence(words, doc, word, labels)
    spread = np.bincount(word[toxic], minlength=len(every))
    often = spread >= max(3, 0.01 * (labels == 1).sum())

    table, bias = np.zeros(SYMBOLS**3), 0.0
    rng = np.random.default_rng(7)
    negative = np.flatnonzero(clean_words)
    for _ in range(ROUNDS):
        # The worst word of each toxic text stands for its toxic sentence.
        ranked = np.where(toxic & ~clean_words[word], value[word], -np.inf)
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, doc, ranked)
        witness = np.unique(word[np.isfinite(ranked) & (ranked >= best[doc])])
        witness = np.union1d(witness, np.flatnonzero(often & ~clean_words))
        hardest = negative[np.argsort(-value[negative], kind="stable")[:1500]]
        others = rng.permutation(negative)[:2500]
        rest = np.unique(np.concatenate([hardest, others]))
        if not len(witness) or not len(rest):
            break
        bent = [b for _ in range(BENT) for b in words.bent(witness, rng)]
        long = (words.end - words.start)[witness] > 4
        chosen = words.picked(np.concatenate([rest, witness]), bent)
        positive = np.arange(len(rest), len(rest) + len(witness) + len(bent))
        # A word counts by the square root of the toxic texts that have it.
        common = np.sqrt(np.maximum(spread[witness], 1))
        common = np.concatenate([common, np.tile(common[long], BENT) / BENT])
        y = np.where(np.arange(len(chosen.start)) < len(rest), -1.0, 1.0)
        kernel = Kernel(chosen)
        marks, columns = kernel.landmarks(positive, np.sqrt(common), LANDMARKS * 3 // 4)
        more, others = kernel.landmarks(np.arange(len(rest)), np.ones(len(rest)), LANDMARKS - LANDMARKS * 3 // 4)
        marks, between = marks + more, np.column_stack(columns + others)
        root, axes = np.linalg.eigh(between[marks])
        good = root > 1e-6
        to_space = axes[:, good] / np.sqrt(root[good])
        weights = np.concatenate([np.full(len(rest), 1 / len(rest)), common / common.sum()]) * len(y) / 2
        w, bias = _svm(between @ to_space, y, weights)
        table = np.zeros(SYMBOLS**3)
        for mark, share in zip(marks, to_space @ w, strict=True):
            triple, weight = kernel.vector(mark)
            np.add.at(table, triple, share * weight)
        value = words.project(every, table) + bias
    table = table.astype(np.float32)
    margins = np.full(len(texts), NOTHING)
    np.maximum.at(margins, doc, (words.project(every, table) + bias)[word])
    slope, offset = 4.0, 0.0
    weights = np.where(labels == 1, 0.5 / max((labels == 1).sum(), 1), 0.5 / max((labels == 0).sum(), 1))
    for _ in range(50):  # logistic fit of the label to the margin, slightly held back
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        g = weights * (p - labels)
        h = np.maximum(weights * p * (1 - p), 1e-9)
        grad = np.array([(g * margins).sum() + 1e-3 * (slope - 4), g.sum()])
        hess = np.array([[(h * margins**2).sum() + 1e-3, (h * margins).sum()], [(h * margins).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        size = np.abs(step).max()
        slope, offset = slope - step[0] * min(1, 2 / size), offset - step[1] * min(1, 2 / size)
        if size < 1e-6:
            break
    return Machine(table, bias, float(slope), float(offset))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, prior: float = 0.05) -> Machine:
    """A machine for ``labels.toxic``, from at most ``rows`` labelled texts that are not held out."""

    def learned(texts: list[str], marks: np.ndarray) -> Machine:
        return learn(texts, marks) if len(set(marks.tolist())) == 2 else Machine(np.zeros(0), 0, 0, 0, prior)

    return fit_in_task(sample(docs, labels, "toxic", rows), learned)


def scorer(machine: Machine):
    def scores(texts: pa.Array) -> np.ndarray:
        parts = [machine.score(part) for _, part in slices(texts)]
        return np.concatenate(parts) if parts else np.zeros(0)

    return scores


RESULTS = T.StructType([T.StructField("score", T.DoubleType())])


def score_toxicity(docs: DataFrame, machine: Machine, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and ``score``, the probability that a text is toxic, one row per row of ``docs``."""
    return with_results(docs, list(keys), RESULTS, lambda: lambda texts, f=scorer(machine): [pa.array(f(texts))])


def keep_clean(docs: DataFrame, machine: Machine, threshold: float = 0.7) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, with all their columns."""
    return keep_rows(docs, lambda: lambda texts, f=scorer(machine): f(texts) < threshold)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    machine = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_toxicity(docs, machine)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )
