"""Language tags from n-gram profiles learned on a labelled table."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioworks.functions.text import ngrams
from folioworks.operators.assembly import SPAN_PARTS
from folioworks.session import materialize

# Log probabilities are kept as whole millionths: integer sums do not depend on
# the order of addition, so labels are the same for every partitioning.
SCALE = 1_000_000
MAX_LANGUAGES = 1000
MAX_BROADCAST_BYTES = 128 * 1024 * 1024
#: Documents that one salt of a very common n-gram stands for, about.
DOCS_PER_SALT = 250_000
#: n-grams up to this length fit in one integer, 21 bits a code point, and are counted in Arrow passes.
PACKED_GRAM = 3
#: Characters whose n-grams a task holds at once, and distinct n-grams it folds before it hands them on.
PIECE_CHARS, FOLDED_GRAMS = 1 << 20, 1 << 21


@dataclass(frozen=True)
class LanguageProfiles:
    """``weights`` has ``gram`` and, per language, what the gram adds to a score."""

    languages: list[str]
    priors: list[int]
    unseen: list[int]
    weights: DataFrame
    n_grams: int
    n: int

    @property
    def size_in_bytes(self) -> int:
        """An upper estimate: key, weights and hash-map overhead per n-gram."""
        return self.n_grams * (64 + 4 * self.n + 8 * len(self.languages))


def _grams(text: str, n: int) -> Column:
    return ngrams(F.lower(F.coalesce(text, F.lit(""))), n)


def _scaled_log(p: Column) -> Column:
    return F.round(F.log(p) * SCALE).cast("bigint")


def _packed_grams(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, n-grams as integers and their rows counted from there, in pieces of some PIECE_CHARS characters."""

    def piece(first: int, held: list[tuple[int, str]]) -> tuple[int, np.ndarray, np.ndarray]:
        codes = np.frombuffer("".join(t for _, t in held).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        sizes = np.array([len(t) for _, t in held], dtype=np.int64)
        entry = np.repeat(np.arange(len(held)), sizes)
        size = max(0, len(codes) - n + 1)
        grams = np.zeros(size, dtype=np.int64)
        for i in range(n):
            grams = grams << 21 | codes[i : i + size]
        inside = entry[:size] == entry[len(entry) - size :]
        rows = np.array([r - first for r, _ in held], dtype=np.int64)
        return first, grams[inside], rows[entry[:size][inside]]

    held, room = [], PIECE_CHARS
    for row, text in enumerate(texts):
        text = text.as_py() or ""
        # the n-grams that begin in a stretch of a long text end in the next one
        for at in range(0, max(len(text), 1), PIECE_CHARS):
            held.append((row, text[at : at + PIECE_CHARS + n - 1]))
            room -= len(held[-1][1])
            if room <= 0:
                yield piece(held[0][0], held)
                held, room = [], PIECE_CHARS
    if held:
        yield piece(held[0][0], held)


#: Distinct n-grams that a table of places may stand for.
DENSE_GRAMS = 1 << 22


def _dense(grams: np.ndarray, n: int, letters: np.ndarray) -> np.ndarray:
    """n-grams as numbers below len(letters) ** n, in the same order; ``letters`` gives each code point's place."""
    size = int(letters.max()) + 1
    places = np.zeros(len(grams), dtype=np.int64)
    for i in reversed(range(n)):
        places = places * size + letters[grams >> 21 * i & 0x1FFFFF]
    return places


def _letters_of(grams: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The code points of n-grams, and a table of each one's place among them."""
    present = np.zeros(0x110000, dtype=bool)
    for i in range(n):
        present[grams >> 21 * i & 0x1FFFFF] = True
    found = np.flatnonzero(present)
    places = np.zeros(0x110000, dtype=np.int64)
    places[found] = np.arange(len(found))
    return found, places


def _unpacked(grams: np.ndarray, n: int) -> pa.Array:
    """The n-grams as strings."""
    codes = np.stack([grams >> 21 * (n - 1 - i) & 0x1FFFFF for i in range(n)], axis=1).astype("<u4")
    text = codes.tobytes().decode("utf-32-le")
    return pa.array([text[i : i + n] for i in range(0, len(text), n)], pa.string())


def _counts(df: DataFrame, text: str, lang: str, n: int) -> DataFrame:
    """lang, gram, cnt of the n-grams of all texts by language."""
    if n > PACKED_GRAM:
        # outer: the plain explode has the optimizer extract all n-grams twice
        rows = df.select(F.col(lang).alias("lang"), F.explode_outer(_grams(text, n)).alias("gram")).filter(F.col("gram").isNotNull())
        return rows.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("cnt"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def folded(of_lang: list) -> tuple[np.ndarray, np.ndarray]:
            grams, inverse = np.unique(np.concatenate([g for g, _ in of_lang]), return_inverse=True)
            counts = np.zeros(len(grams), dtype=np.int64)
            np.add.at(counts, inverse, np.concatenate([c for _, c in of_lang]))
            return grams, counts

        def rows() -> Iterator[pa.RecordBatch]:
            for name, of_lang in held.items():
                grams, counts = folded(of_lang)
                names = pa.array([name], pa.string()).take(pa.array(np.zeros(len(grams), dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([names, _unpacked(grams, n), pa.array(counts)], names=["lang", "gram", "cnt"])

        for batch in batches:
            names = batch.column(0).dictionary_encode()
            which = np.asarray(names.indices).astype(np.int64)
            for first, grams, row in _packed_grams(batch.column(1), n):
                of = which[first + row]
                for i in np.unique(of):
                    found = np.unique(grams[of == i], return_counts=True)
                    held.setdefault(names.dictionary[int(i)].as_py(), []).append(found)
                    size += len(found[0])
                if size >= FOLDED_GRAMS:
                    held = {name: [folded(of_lang)] for name, of_lang in held.items()}
                    size = sum(len(of_lang[0][0]) for of_lang in held.values())
                    if size >= FOLDED_GRAMS // 2:
                        yield from rows()
                        held, size = {}, 0
        yield from rows()

    texts = df.select(F.col(lang).cast("string").alias("lang"), F.lower(F.coalesce(text, F.lit(""))).alias("text"))
    found = texts.mapInArrow(count, "lang string, gram string, cnt bigint")
    return found.groupBy("lang", "gram").agg(F.sum("cnt").alias("cnt"))


def fit_language_profiles(
    df: DataFrame, text: str = "text", lang: str = "lang", n: int = 3, max_languages: int = MAX_LANGUAGES
) -> LanguageProfiles:
    """Count n-grams per language and turn them into add-one log weights.

    Rows without a label teach nothing. Counting folds before its shuffle. The
    counts are written once to the shared folder; only one row per language
    comes to the driver, and more than ``max_languages`` of them are an error.
    """
    df = df.filter(F.col(lang).isNotNull())
    docs = df.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("docs"))
    head = docs.orderBy("lang").limit(max_languages + 1).collect()
    if len(head) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    k = range(len(head))
    counts = _counts(df, text, lang, n)
    of_lang = [F.when(F.col("lang") == head[i]["lang"], F.col("cnt")).otherwise(0) for i in k]
    by_gram = materialize(counts.groupBy("gram").agg(*[F.sum(of_lang[i]).alias(f"c{i}") for i in k]))
    sizes = by_gram.agg(
        F.count(F.lit(1)).alias("grams"), *[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"t{i}") for i in k]
    ).first()
    room = [sizes[f"t{i}"] + max(sizes["grams"], 1) for i in k]
    all_docs = sum(r["docs"] for r in head)
    base = by_gram.sparkSession.range(1).select(
        *[_scaled_log(F.lit(head[i]["docs"]) / F.lit(all_docs)).alias(f"p{i}") for i in k],
        *[_scaled_log(F.lit(1) / F.lit(room[i])).alias(f"u{i}") for i in k],
    ).first()
    unseen = [base[f"u{i}"] for i in k]
    weights = by_gram.select(
        "gram",
        *[(_scaled_log((F.col(f"c{i}") + 1) / F.lit(room[i])) - unseen[i]).alias(f"w{i}") for i in k],
    )
    return LanguageProfiles(
        [r["lang"] for r in head], [base[f"p{i}"] for i in k], unseen, weights, sizes["grams"], n
    )


def with_seams(parts: DataFrame, size: int, span: int = SPAN_PARTS) -> DataFrame:
    """Texts of parts (doc_id, part_no, n_parts, text) in lower case, and beside them the texts over their seams.

    A seam holds the last ``size`` characters before a part and the first ``size`` of it, so its n-grams of
    ``size`` + 1 characters are those that neither side holds: all rows of a document together have the n-grams
    of the whole text, each once. Only seams are shuffled: parts without a text fall out, and then the last
    ``size`` tails hold enough characters.
    Parts fall into spans, so a window holds at most ``span`` rows of a document, or one row per span.
    """
    own = parts.select("doc_id", "part_no", "n_parts", F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    edges = own.filter((F.col("n_parts") > 1) & (F.length("text") > 0)).select(
        "doc_id", "part_no", F.floor(F.col("part_no") / span).alias("_span"),
        F.left("text", F.lit(size)).alias("_head"), F.right("text", F.lit(size)).alias("_tail"),
    )

    def earlier(tail: str, order: str, *keys: str) -> Column:
        before = Window.partitionBy(*keys).orderBy(order).rowsBetween(-size, -1)
        return F.right(F.array_join(F.collect_list(tail).over(before), ""), F.lit(size))

    # read twice, and much smaller than what it is made of
    near = materialize(edges.withColumn("_near", earlier("_tail", "part_no", "doc_id", "_span")))
    ends = near.groupBy("doc_id", "_span").agg(
        F.max_by(F.right(F.concat("_near", "_tail"), F.lit(size)), "part_no").alias("_end")
    )
    far = ends.select("doc_id", "_span", earlier("_end", "_span", "doc_id").alias("_far"))
    halo = F.right(F.concat("_far", "_near"), F.lit(size))
    seams = near.join(far, ["doc_id", "_span"]).select("doc_id", "part_no", F.concat(halo, "_head").alias("text"))
    return own.select("doc_id", "part_no", "text").union(seams.filter(F.length("text") > size))


def _score(df: DataFrame, doc_id: str, text: str, profiles: LanguageProfiles) -> DataFrame:
    """doc_id, grams and one sum of weights per language (s0, s1, ...) of each text, or of each stretch of a long one."""
    k, n = len(profiles.languages), profiles.n
    made = profiles.weights.select("gram", *[f"w{i}" for i in range(k)]).toArrow().combine_chunks()
    packed = np.concatenate([np.zeros(0, dtype=np.int64), *[g for _, g, _ in _packed_grams(made["gram"].combine_chunks(), n)]])
    order = np.argsort(packed)
    # the last row is for n-grams that are not known
    weights = np.zeros((len(packed) + 1, k), dtype=np.int64)
    for i in range(k):
        weights[:-1, i] = np.asarray(made[f"w{i}"])[order]
    known = df.sparkSession.sparkContext.broadcast((packed[order], weights))
    sums = [f"s{i}" for i in range(k)]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, weights = known.value
        found_in, places = _letters_of(keys, n)
        table = None
        if 0 < (len(found_in) + 1) ** n <= DENSE_GRAMS:
            # place 0 is any other code point, so n-grams with one meet no key
            places[found_in] += 1
            table = np.full((len(found_in) + 1) ** n, len(keys), dtype=np.int32)
            table[_dense(keys, n, places)] = np.arange(len(keys))

        def rows_of(grams: np.ndarray) -> np.ndarray:
            if table is not None:
                return table[_dense(grams, n, places)]
            found = np.searchsorted(keys, grams)
            found[found == len(keys)] = 0
            return np.where(keys[found] == grams, found, len(keys)) if len(keys) else found

        for batch in batches:
            for first, grams, row in _packed_grams(batch.column(1), n):
                # rows of a piece are in order; those without n-grams count for nothing and come below
                count = np.bincount(row)
                has = np.flatnonzero(count)
                ends = np.cumsum(count)[has]
                totals = np.add.reduceat(weights[rows_of(grams)], ends - count[has], axis=0) if len(has) else np.zeros((0, k), dtype=np.int64)
                columns = [pa.array(count[has].astype(np.int64)), *[pa.array(np.ascontiguousarray(totals[:, i])) for i in range(k)]]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first + has)), *columns], names=["doc_id", "grams", *sums])
            # a text too short for any n-gram is decided by the priors
            none = [pa.array(np.zeros(batch.num_rows, dtype=np.int64))] * (k + 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *none], names=["doc_id", "grams", *sums])

    rows = df.select(F.col(doc_id).alias("doc_id"), F.lower(F.coalesce(text, F.lit(""))).alias("text"))
    schema = rows.select("doc_id", *[F.lit(0).cast("bigint").alias(c) for c in ("grams", *sums)]).schema
    return rows.mapInArrow(score, schema)


def tag_language(
    df: DataFrame,
    profiles: LanguageProfiles,
    doc_id: str = "doc_id",
    text: str = "text",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``doc_id, language``: the most likely language of all texts of a document.

    A profile below the broadcast limit is looked up where the n-grams arise, in
    an Arrow pass, so none of them becomes a row: only sums per text are shuffled.
    A larger profile is joined by shuffle, n-grams counted per document first
    and spread by salt, since some n-grams occur in most documents. A table of parts
    (with ``part_no`` and ``n_parts``) is read as whole texts: the tags don't depend on where they are cut.
    """
    if {"part_no", "n_parts"} <= set(df.columns) and profiles.n > 1:
        df = with_seams(df.select(F.col(doc_id).alias("doc_id"), "part_no", "n_parts", F.col(text).alias("text")), profiles.n - 1)
        doc_id = text = None
    doc_id, text = doc_id or "doc_id", text or "text"
    k = range(len(profiles.languages))
    if profiles.size_in_bytes <= max_broadcast_bytes and profiles.n <= PACKED_GRAM:
        scored = _score(df, doc_id, text, profiles)
        sums = scored.groupBy("doc_id").agg(F.sum("grams").alias("grams"), *[F.sum(f"s{i}").alias(f"s{i}") for i in k])
    else:
        # explode_outer: a text too short for any n-gram is decided by the priors
        grams = df.select(F.col(doc_id).alias("doc_id"), F.explode_outer(_grams(text, profiles.n)).alias("gram"))
        one = F.when(F.col("gram").isNotNull(), 1).otherwise(0)
        if profiles.size_in_bytes <= max_broadcast_bytes:
            joined = grams.withColumn("cnt", one).join(F.broadcast(profiles.weights), "gram", "left")
        else:
            counted = grams.groupBy("doc_id", "gram").agg(F.sum(one).alias("cnt"))
            # some n-grams occur in nearly every document, so the salts grow with the documents
            salts = 32 + df.count() // DOCS_PER_SALT
            salted = counted.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
            copies = profiles.weights.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
            joined = salted.join(copies, ["gram", "salt"], "left")
        sums = joined.groupBy("doc_id").agg(
            F.sum("cnt").alias("grams"),
            *[F.sum(F.coalesce(f"w{i}", F.lit(0)) * F.col("cnt")).alias(f"s{i}") for i in k],
        )
    costs = F.array(
        *[
            F.struct(
                (-(F.col(f"s{i}") + F.col("grams") * profiles.unseen[i] + profiles.priors[i])).alias("cost"),
                F.lit(profiles.languages[i]).alias("language"),
            )
            for i in k
        ]
    )
    return sums.select("doc_id", F.array_min(costs)["language"].alias("language"))
