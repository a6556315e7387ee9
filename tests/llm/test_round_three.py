"""Edit fingerprints, spelling variants and importance resampling against brute force."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from folioworks.llm import edit_fingerprint as ef
from folioworks.llm import importance, spelling
from folioworks.llm.words import mix

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- edit fingerprints


def emitted(text):
    """The walk, one step at a time: the class under the pointer at every step."""
    out = []
    for kind in ef.classes(text).tolist():
        while True:
            out.append(kind)
            move = int(mix(np.array([(len(out) - 1) % ef.PERIOD * ef.CLASSES + kind], dtype=np.uint64))[0] >> np.uint64(63))
            if move:
                break
    return out


def plain_print(text):
    steps = emitted(text)
    bits = [int(ef._BITS[i * ef.CLASSES + steps[s]]) for i, s in enumerate(ef.STEPS.tolist()) if s < len(steps)]
    bits += [0] * (-len(bits) % 8)
    raw = bytes(int("".join(map(str, bits[i : i + 8])), 2) for i in range(0, len(bits), 8))
    return f"{len(steps):x}." + base64.b64encode(raw).decode().rstrip("=")


def test_walk_against_single_steps():
    rng = random.Random(3)
    for n in (0, 1, 2, 7, 63, 64, 200, 5000):
        text = "".join(rng.choice("abc dé漢😀") for _ in range(n))
        made = ef.of_text(text)
        assert str(made) == plain_print(text)
        again = ef.parse(str(made))
        assert again.steps == made.steps and again.bits.tolist() == made.bits.tolist()
    # A walk that goes on from a step is the rest of the whole walk.
    kinds = ef.classes("abcdefgh" * 900)
    whole = ef.arrivals(kinds)
    assert ef.arrivals(kinds[3000:], int(whole[3000])).tolist() == whole[3000:].tolist()


def test_few_edits_stay_near_and_others_do_not():
    rng = random.Random(8)
    near, far = [], []
    for _ in range(60):
        text = "".join(rng.choice("etaoin shrdlu") for _ in range(2000))
        edited = list(text)
        for _ in range(3):
            edited[rng.randrange(len(edited))] = rng.choice(["", "x", "yz"])
        near.append(ef.likeness(ef.of_text(text), ef.of_text("".join(edited))))
        far.append(ef.likeness(ef.of_text(text), ef.of_text("".join(rng.choice("etaoin shrdlu") for _ in range(2000)))))
    assert np.median(near) > 0.8 and np.median(far) < 0.25 and max(far) < 0.5
    assert ef.likeness(ef.of_text("abc"), ef.of_text("abc")) == 1.0
    assert ef.likeness(ef.of_text(""), ef.of_text("")) == 1.0 and ef.likeness(ef.of_text(""), ef.of_text("abc")) == 0.0


def brute_next(rows):
    """RESULT of unique ids, from the rows in order."""
    ordered = sorted(rows)
    out = {}
    for i, (doc_id, text) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = (ef.of_text(t) for t in (text, edited, following))
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), str(a), str(b), ef.likeness(a, b), ef.likeness(a, c))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_next_document_against_brute_force(spark, table, parts):
    docs = table("documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    rows += [(10_001, None), (10_003, ""), (-5, "😀é" * 70), (10_002, "one")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(-1) for c in ("row", "h", "part", "place")})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.doc_id: tuple(r)[1:] for r in ef.with_next(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute_next(rows)
    prints = {r.doc_id: r.fingerprint for r in ef.fingerprints(docs).collect()}
    assert prints == {i: x[2] for i, x in got.items()}


def test_odd_rows_of_fingerprints(spark, odd_docs, no_docs):
    rows = ef.with_next(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    lone = [r for r in rows if r.doc_id is None][0]
    assert lone.edited_sha256 == hashlib.sha256(b"no id ").hexdigest() or lone.n_chars == 10
    fours = [r for r in rows if r.doc_id == 4]
    assert len(fours) == 2 and len({r.fingerprint for r in fours}) == 1 and sorted(r.near_next for r in fours) == [1.0, 1.0]
    assert ef.with_next(no_docs).count() == 0
    alone = ef.with_next(odd_docs.filter("doc_id = 7")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def test_edit_distance_against_the_table():
    rng = random.Random(6)
    for _ in range(400):
        a, b = ("".join(rng.choice("abé") for _ in range(rng.randrange(0, 14))) for _ in range(2))
        assert ef.edit_distance(a, b) == plain_distance(a, b), (a, b)
    a = "".join(rng.choice("abcdefgh ") for _ in range(300))
    b = list(a)
    for _ in range(20):
        b[rng.randrange(len(b))] = rng.choice(["", "x", "yz"])
    assert ef.edit_distance(a, "".join(b)) == plain_distance(a, "".join(b))


def test_groups_of_near_texts(spark, odd_docs, no_docs):
    rng = random.Random(10)
    rows, family = [], {}
    for f in range(25):
        base = "".join(rng.choice("etaoin shrdlu") for _ in range(rng.randrange(300, 1200)))
        for k in range(4):
            text = list(base)
            for _ in range(k):
                i = rng.randrange(len(text))
                text[i] = rng.choice(["", "x", text[i] + "y"])
            rows.append((len(rows), "".join(text)))
            family[len(rows) - 1] = 4 * f
    rows.append((500, rows[0][1]))
    got = {r.doc_id: r.component_id for r in ef.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    assert got[500] == got[0] and all(got[i] // 4 == f // 4 for i, f in family.items()), "no link between families"
    assert sum(got[i] == f for i, f in family.items()) >= 0.9 * len(family)
    odd = ef.near_groups(odd_docs).collect()
    ids = {r.doc_id: r.component_id for r in odd if r.doc_id != 9}
    assert len(odd) == odd_docs.count() and ids[None] is None and ids[5] == ids[6] == 4 and ids[8] == 7 and ids[2] == 1 and ids[10] == 10
    assert ef.near_groups(no_docs).count() == 0


# -- spelling variants


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(n, ratio=10):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def vocabulary(rng, count):
    words = {}
    while len(words) < count:
        w = "".join(rng.choice("abcdeéÀ") for _ in range(rng.randrange(7, 10)))
        words[w] = rng.choice([2, 3, 25, 300, 4000])
        for _ in range(3):
            i = rng.randrange(len(w))
            v = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("xyzab") + w[i:], w[:i] + rng.choice("xyzab") + w[i + 1 :]])
            words.setdefault(v, rng.choice([2, 30, 400]))
    return words


@pytest.mark.parametrize("small", [False, True])
def test_variants_against_all_pairs(spark, small):
    # With small ones, several shards of a length and several passes.
    sizes = {"of_shard": 8, "pass_bytes": 1200} if small else {}
    rng = random.Random(5)
    words = vocabulary(rng, 500)
    long = "".join(rng.choice("ab") for _ in range(300))
    words |= {long: 50, long[:100] + long[101:]: 3, "a" * 64: 2, "a" * 65: 40, "a" * 63: 400, "aabaaba": 7}
    df = spark.createDataFrame(sorted(words.items()), "word string, n bigint").repartition(3)
    got = [tuple(r) for r in spelling.variants(df, **sizes).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(words) and set(got) == brute_variants(words)


def test_false_hits_are_few_and_none_is_lost():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, (1 << 64) - 1, 40_000, dtype=np.uint64)
    blocks = {7: -(-len(keys) // spelling.BLOCK_WORDS)}
    bits = np.zeros(blocks[7] * 8, dtype=np.uint64)
    for part in (keys, mix(keys)):
        word, marks = spelling._marks(part)
        np.bitwise_or.at(bits, spelling._blocks(keys, blocks[7]) * 8 + word, marks)
    filters = spelling.Filters(blocks, {(7, 0): bits.tobytes()})
    assert len(filters.hits(keys, 7)) == len(keys) and len(filters.hits(keys, 8)) == 0
    others = rng.integers(0, (1 << 64) - 1, 200_000, dtype=np.uint64)
    assert len(filters.hits(others, 7)) < 0.01 * len(others)


def test_edit_hashes_are_those_of_the_edited_words():
    word = np.frombuffer(b"abbacad", dtype=np.uint8)[None, :]

    class Every:
        bits = {7: None}

        def hits(self, keys, size):
            self.keys.append((size, keys))
            return np.arange(len(keys))

    every = Every()
    every.keys = []
    made = [(edits.shape[1], bytes(e)) for _, edits in spelling.hits(7, word, np.frombuffer(b"abcdz", dtype=np.uint8), every) for e in edits]
    whole = [(size, int(k)) for size, keys in every.keys for k in keys]
    again = []
    for size, e in made:
        letters = np.frombuffer(e, dtype=np.uint8)
        again.append((size, int(spelling.keys_of((spelling._CHARACTER[letters] * spelling._powers(size)).sum(keepdims=True, dtype=np.uint64), size)[0])))
    assert whole == again and len(set(made)) == len(made)
    assert {e.decode() for s, e in made if s == 6} == {"bbacad", "abacad", "abbcad", "abbaad", "abbacd", "abbaca"}


def test_counting_of_runs(spark, odd_docs, no_docs):
    rows = [(i, "Abcdefgh ÀBCDEFGé-zzzzzzz, short ABCDEFGH1abcdefgh") for i in range(200)] + [(None, "abcdefgh"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("word", F.lit(1))
    want = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                want[run] += 1
    assert {r.word: r.n for r in spelling.counted(docs).collect()} == {w: n for w, n in want.items() if n >= 2}
    assert spelling.variants(spelling.counted(odd_docs)).count() == spelling.counted(odd_docs).count()
    assert spelling.variants(spelling.counted(no_docs)).count() == 0


# -- importance resampling


def runs_of(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def test_span_crcs_of_any_length():
    rng = random.Random(1)
    lengths = [1, 2, 3, 4, 5, 255, 256, 257, 511, 512, 513, 700, 5000]
    words = [bytes(rng.choice(b"abc019\xc3\xa9") for _ in range(rng.choice(lengths))) for _ in range(80)]
    data = np.frombuffer(b" ".join(words) + b" ", dtype=np.uint8)
    size = np.array([len(w) for w in words])
    end = np.cumsum(size + 1) - 1
    assert importance.span_crcs(data, end - size, end).tolist() == [zlib.crc32(w) for w in words]


def test_features_of_odd_texts():
    texts = ["", "One", "one TWO\x00two", "É É é ß 漢字漢字 " * 3, "a" * 3000 + " b", "...", "x1-y2_z3`{}~\x7f9", "Ω" * 400 + " " + "Ω" * 200]
    found = importance.Features([t.encode() for t in texts])
    for i, t in enumerate(texts):
        got = Counter(found.buckets[found.owner == i].tolist())
        assert got == Counter(zlib.crc32(f.encode()) % 10_000 for f in runs_of(t)), t
        assert found.words[i] == (len(runs_of(t)) + 1) // 2


def brute_resample(rows, target, percent, least):
    counts = [Counter(zlib.crc32(f.encode()) % 10_000 for _, t in some for f in runs_of(t)) for some in (rows, target)]
    s_all, t_all = (sum(c.values()) for c in counts)
    gain = lambda b: math.floor(1000 * math.log((counts[1][b] + 1) * (s_all + 10_000) / ((counts[0][b] + 1) * (t_all + 10_000))))
    out = []
    for doc_id, t in rows:
        f = runs_of(t)
        weight = sum(gain(zlib.crc32(x.encode()) % 10_000) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    order = sorted((r for r in out if (r[1] + 1) // 2 >= least), key=lambda r: (-r[3], r[0] is None, r[0], r[1], r[2]))
    for rank, r in enumerate(order[: len(order) * percent // 100], 1):
        r[4] = rank
    return sorted(map(tuple, out), key=repr)


def test_resampling_against_brute_force(spark, table, odd_docs, no_docs):
    target = table("benchmark")
    goal = [tuple(r) for r in target.select("item_id", "text").collect()]
    for docs in (table("documents"), odd_docs):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        for least, percent in ((20, 25), (1, 100)):
            got = importance.resample(docs.repartition(3), target, least_words=least, percent=percent).collect()
            assert sorted(map(tuple, got), key=repr) == brute_resample(rows, goal, percent, least)
    assert importance.resample(no_docs, target).count() == 0
    assert importance.resample(odd_docs, no_docs).count() == odd_docs.count()


def test_ranks_span_parts(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), F.lit(3).alias("rank_"))
    got = importance.numbered(df, F.desc("a")).collect()
    assert sorted(r.rank for r in got) == list(range(1, 1001))
    assert [r.a for r in sorted(got, key=lambda r: r.rank)] == sorted((i % 7 for i in range(1000)), reverse=True)


@pytest.mark.parametrize("name", ["op12_spelling", "op13_resample"])
def test_sql_at_the_larger_scale(spark, name):
    import __spark_entry__ as entry

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    answer = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    got = entry.queries()[name](spark, "/root/testdata/sf0.01").select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(answer.fetchall(), key=repr)
