"""Language of web pages: Bayesian fusion of text, declared markup language, address suffix and host.

* Text: log likelihoods of hashed runs of three bytes under each language, from a bounded
  number of labelled texts of each; long texts count as ``TEXT_RUNS`` runs, since runs are not independent.
* Declared language and address suffix: P(declared | language) and P(suffix | language),
  counted over all pages by their text's best language, smoothed by one count.
* Host: P(language | host) from the pages of the host other than the page itself, smoothed
  towards the host's registered domain, that towards all pages (``WEIGHT`` counts each).

All counts are grouped aggregations over whole tables and joined back by host, declared
language and suffix; values that many pages share are joined in ``SALTS`` parts.

Defined results: a page without text, host or declared language gets no evidence from it
(null html or url alike); a page without any evidence gets the commonest language. Ties go to
the first language by name. Rows without page_id are scored like the others; repeated rows
are scored each. Without labelled texts the language is null. Other columns are not read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioworks.llm.words import row_batches, slices
from folioworks.session import materialize

#: Labelled texts of each language for the fit, at most.
SAMPLE_ROWS = 6000
BUCKETS = 1 << 16
TEXT_RUNS = 60.0
WEIGHT = 4.0
#: Parts in which a value of more than one in ``SALTS`` pages is joined.
SALTS = 64


def visible(html: Column) -> Column:
    """Text of a page: scripts, styles, comments and tags out, references and blank runs as one space."""
    out = F.regexp_replace(html, r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#\w]+;", " ")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def declared(html: Column) -> Column:
    """The primary language that the html element names, in lower case."""
    found = F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?\s*([a-z]{2,3})\b", 1))
    return F.when(found != "", found)


def host(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def _runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the three-byte runs of some texts, and their text numbers."""
    data = np.frombuffer((b"\n".join(texts) + b"\n\n\n").lower(), dtype=np.uint8).astype(np.uint32)
    key = (data[:-2] * np.uint32(65599) + data[1:-1]) * np.uint32(65599) + data[2:]
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    doc = np.repeat(np.arange(len(texts)), np.maximum(lengths - 2, 0))
    first = np.cumsum(lengths + 1) - lengths - 1
    size = np.maximum(lengths - 2, 0)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
    return ((key[at] * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64), doc


def fit_text(docs: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and the log likelihood of each bucket under each, from each language's texts of lowest hash."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    known = known.select("doc_id", "lang", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)).alias("hash"))
    ids = known.select("lang", "doc_id", "hash").distinct()
    # Languages of many texts are thinned by hash before they are ordered.
    part = F.broadcast(ids.groupBy("lang").agg((F.lit(2.0 * rows) / F.count("*")).alias("part")))
    few = ids.join(part, "lang").filter(F.col("hash") < F.col("part") * (1 << 40))
    order = Window.partitionBy("lang").orderBy("hash", "doc_id")
    chosen = few.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= rows).select("lang", "doc_id", "hash")
    found = known.join(F.broadcast(chosen), ["lang", "doc_id", "hash"], "left_semi")

    def count(batches):
        for batch in row_batches(batches):
            names = np.array(batch.column(0).to_pylist(), dtype=object)
            for first, texts in slices(batch.column(1)):
                bucket, doc = _runs(texts)
                mine = names[first : first + len(texts)]
                for name in set(mine):
                    runs = np.bincount(bucket[(mine == name)[doc]], minlength=BUCKETS)
                    # A language of texts without runs is one too.
                    seen = np.union1d(np.flatnonzero(runs), [0])
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(seen)), pa.array(seen), pa.array(runs[seen])], names=["lang", "bucket", "n"])

    def build(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            names, bucket, n = batch.column(0).dictionary_encode(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            place = names.indices.to_numpy()
            for i, name in enumerate(names.dictionary.to_pylist()):
                counts.setdefault(name, np.zeros(BUCKETS, dtype=np.float32))[bucket[place == i]] = n[place == i]
        languages = sorted(counts)
        logs = np.empty((len(languages), BUCKETS), dtype=np.float32)
        for i, name in enumerate(languages):
            seen = counts.pop(name).astype(float)
            logs[i] = np.log((seen + 0.5) / (seen.sum() + 0.5 * BUCKETS))
        if languages:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((languages, logs))], pa.binary())], names=["model"])

    counted = found.select("lang", "text").mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    made = counted.repartition(1).mapInArrow(build, "model binary").first()
    return pickle.loads(made.model) if made else ([], np.zeros((0, BUCKETS), dtype=np.float32))


def _normal(column: Column) -> Column:
    """Log weights as probabilities."""
    top = F.array_max(column)
    powers = F.transform(column, lambda v: F.exp(v - top))
    total = F.aggregate(powers, F.lit(0.0), lambda a, v: a + v)
    return F.transform(powers, lambda v: v / total)


def _by_language(pages: DataFrame, name: str, count: int) -> DataFrame:
    """Of each value of ``name``, ``by_<name>``: its pages by their text's best language."""
    counts = pages.filter(F.col(name).isNotNull()).groupBy(name, "best").agg(F.count("*").alias("n"))
    known = F.when(F.col("best").isNotNull(), F.struct("best", "n"))
    held = counts.groupBy(name).agg(F.map_from_entries(F.collect_list(known)).alias("held"))
    each = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda k: F.coalesce(F.element_at("held", k.cast("bigint")), F.lit(0).cast("bigint")))
    return held.select(name, each.alias(f"by_{name}"))


def _conditional(rows: DataFrame, pages: DataFrame, name: str, count: int) -> DataFrame:
    """``rows``, made from ``pages``, with ``log_<name>``: log P(value of ``name`` | language), by language number."""
    counts = materialize(_by_language(pages, name, count))
    named = pages.filter(F.col(name).isNotNull())
    totals = {r.best: r.n for r in named.filter(F.col("best").isNotNull()).groupBy("best").agg(F.count("*").alias("n")).collect()}
    values, total = counts.count(), named.count()
    size = F.lit([float(totals.get(k, 0)) for k in range(count)])
    logs = F.zip_with(f"by_{name}", size, lambda c, t: F.log((c + 1.0) / (t + values + 1.0)))
    # At most SALTS values.
    common = [r[name] for r in named.groupBy(name).count().filter(F.col("count") * SALTS > total).collect()]
    hot = F.col(name).isin(common) if common else F.lit(False)
    salt = F.pmod(F.xxhash64("page_id", "host", "log_text"), F.lit(SALTS)).cast("int")
    table = counts.select(name, logs.alias(f"log_{name}"), F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    salted = rows.withColumn("salt", F.when(F.col(name).isNull() | hot, salt).otherwise(0))
    return salted.join(table, [name, "salt"], "left").drop("salt")


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, lang, confidence, text_lang, declared, host of every row of ``pages``."""
    languages, logs = fit_text(docs)
    html = F.coalesce("html", F.lit(""))
    facts = pages.select(
        "page_id", visible(html).alias("text"), declared(html).alias("declared"), host(F.col("url")).alias("host")
    )
    out = ["page_id", "lang", "confidence", "text_lang", "declared", "host"]
    if not languages:
        nothing = F.lit(None).cast("string")
        return facts.select("page_id", nothing.alias("lang"), F.lit(None).cast("double").alias("confidence"), nothing.alias("text_lang"), "declared", "host")
    n = len(languages)

    def run(batches):
        for batch in row_batches(batches):
            parts = []
            for _, texts in slices(batch.column(1)):
                bucket, doc = _runs(texts)
                runs = np.bincount(doc, minlength=len(texts))
                total = np.column_stack([np.bincount(doc, weights=row[bucket], minlength=len(texts)) for row in logs])
                total -= total.max(axis=1, keepdims=True)
                parts.append(total * np.where(runs > TEXT_RUNS, TEXT_RUNS / np.maximum(runs, 1), 1.0)[:, None])
            likelihood = np.concatenate(parts)
            best = pa.array(likelihood.argmax(axis=1), mask=(likelihood == 0).all(axis=1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(likelihood) + 1, dtype=np.int32) * n), pa.array(likelihood.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), best, lists], names=["page_id", "declared", "host", "best", "log_text"]
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    read = facts.mapInArrow(run, f"page_id {kind}, declared string, host string, best bigint, log_text array<double>")
    read = read.withColumn("suffix", F.substring_index("host", ".", -1)).withColumn("domain", F.substring_index("host", ".", -2))
    read = materialize(read)

    # Counts of best languages by host, domain and over all; then priors with the page's own vote taken out.
    votes = {r.best: r.n for r in read.filter(F.col("best").isNotNull()).groupBy("best").agg(F.count("*").alias("n")).collect()}
    total = sum(votes.values())
    share = F.lit([(votes.get(k, 0) + 1.0) / (total + n) for k in range(n)])
    none = F.lit([0] * n).cast("array<bigint>")

    def left_out(name: str) -> Column:
        """Counts of ``name`` without the page itself."""
        own = lambda c, k: c - F.when(F.col("best") == k, 1).otherwise(0)
        return F.when(F.col(name).isNotNull(), F.transform(name, own)).otherwise(none)

    size = lambda name: F.aggregate(name, F.lit(0).cast("bigint"), lambda a, c: a + c)

    fused = read.join(_by_language(read, "host", n), "host", "left").join(_by_language(read, "domain", n), "domain", "left")
    for name in ("declared", "suffix"):
        fused = _conditional(fused, read, name, n)
    fused = fused.withColumns({"by_host": left_out("by_host"), "by_domain": left_out("by_domain")})
    fused = fused.withColumns({"domain_size": size("by_domain"), "host_size": size("by_host")})
    domain = F.zip_with("by_domain", share, lambda c, s: (c + WEIGHT * s) / (F.col("domain_size") + WEIGHT))
    prior = F.zip_with("by_host", F.col("by_domain_p"), lambda c, p: F.log((c + WEIGHT * p) / (F.col("host_size") + WEIGHT)))
    fused = fused.withColumn("by_domain_p", domain).withColumn("log_host", prior)
    zero = F.lit([0.0] * n)
    logs_of = [F.coalesce(c, zero) for c in ("log_text", "log_declared", "log_suffix", "log_host")]
    weight = F.transform(F.arrays_zip(*[c.alias(f"e{i}") for i, c in enumerate(logs_of)]), lambda e: e["e0"] + e["e1"] + e["e2"] + e["e3"])
    fused = fused.withColumn("p", _normal(weight)).withColumn("confidence", F.array_max("p"))
    names = F.lit(languages)
    place = F.array_position("p", F.col("confidence"))
    return fused.select(
        "page_id", F.element_at(names, place.cast("int")).alias("lang"), "confidence",
        F.when(F.col("best").isNotNull(), F.element_at(names, (F.col("best") + 1).cast("int"))).alias("text_lang"), "declared", "host",
    ).select(out)


def op8_page_language(spark, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/documents.parquet"))
