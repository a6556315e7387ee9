import random
import re

import numpy as np
from pyspark.sql import functions as F

from folioworks.llm import linking, prefix_join
from folioworks.llm import near_dedup as nd
from folioworks.llm.components import components
from folioworks.llm.words import mix


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def groups(rows, n, percent=80):
    """Least doc_id that each id reaches, by comparing all pairs."""
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    least = {i: i for i, _ in sets}
    links = [(a, b) for a, x in sets for b, y in sets if a < b and x and y and 100 * len(x & y) >= percent * len(x | y)]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            if (least[a], least[b]) != (low, low):
                least[a] = least[b] = low
                changed = True
    return least


def corpus():
    rng = random.Random(11)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("lo", "Mi", "nu", "ra", "è")]
    rows = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randrange(1, 60))]
        rows.append(" ".join(base))
        for _ in range(rng.randrange(0, 4)):
            other = list(base)
            for _ in range(rng.randrange(0, 4)):
                other[rng.randrange(len(other))] = rng.choice(words)
            rows.append(rng.choice([" ", "\n", " \t"]).join(other))
    # One chain: each text is near the next, the ends are far apart.
    chain = [f"c{i}" for i in range(60)]
    rows += [" ".join(chain[i : i + 40]) for i in range(0, 20, 2)]
    rng.shuffle(rows)
    return [(1000 - 3 * i, t) for i, t in enumerate(rows)]


def test_groups_against_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for n in (2, 5):
        got = {r.doc_id: r.component_id for r in nd.near_duplicates(docs, words=n).collect()}
        assert got == groups(rows, n)
        assert len(set(got.values())) < len(rows) - 5


def test_few_rounds_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(linking, "ROUNDS", 1)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in nd.near_duplicates(docs, words=2).collect()} == groups(rows, 2)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = nd.near_duplicates(odd_docs, words=2).collect()
    assert len(rows) == odd_docs.count()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got[1] == (0, 1) and got[2] == (0, 2) and got[3] == (0, 3) and got[None] == (2, None)
    assert got[4] == got[5] == got[6] == (1, 4) and got[8][1] == 7
    assert nd.near_duplicates(no_docs).count() == 0
    kept = nd.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(r.doc_id or 0 for r in kept.collect())
    assert ids == [0, 1, 2, 3, 4, 7, 9, 9, 10, 11]


def test_texts_of_one_id_are_kept_apart(spark):
    near = [f"a{i}" for i in range(60)]
    other, far = [f"b{i}" for i in range(60)], [f"c{i}" for i in range(60)]
    line = lambda words, last: " ".join([*words, last])
    rows = [(3, line(near, "x")), (5, line(near, "y")), (5, line(other, "x")), (7, line(other, "x")), (8, line(other, "y"))]
    rows += [(1, line(far, "x")), (5, line(far, "y")), (5, " ".join(far[:2])), (9, line(near, "z"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted([(3, 3), (5, 3), (5, 5), (7, 5), (8, 5), (1, 1), (5, 1), (5, 5), (9, 3)])
    for parts in (1, 4):
        split = docs.repartition(parts)
        assert sorted((r.doc_id, r.component_id) for r in nd.near_duplicates(split, words=2).collect()) == want
    kept = sorted((r.doc_id, r.text) for r in nd.keep_first(docs, words=2).collect())
    assert kept == sorted([rows[0], rows[2], rows[5], rows[7]])


def test_one_row_of_each_group_stays(spark):
    words = [f"a{i}" for i in range(60)]
    a, near = " ".join(words), " ".join([*words, "more"])
    rows = [(5, a, "x"), (5, a.replace(" ", "  "), "y"), (5, a.upper(), "z"), (5, near, "x"), (6, a, "x"), (7, "alone", "q"), (7, "alone", "p"), (8, "", "q"), (8, "", "p"), (8, None, "p")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _text_hash_ string").withColumns({c: F.lit("t") for c in ("row_hash", "c", "own", "least")})
    got = [tuple(r) for r in nd.keep_first(docs).collect()]
    assert sorted(r[0] for r in got) == [5, 7, 8, 8] and {r[1] for r in got if r[0] == 8} == {"", None}
    for parts in (1, 5):
        assert sorted(map(repr, map(tuple, nd.keep_first(docs.repartition(parts)).collect()))) == sorted(map(repr, got))
    copies = docs.union(docs).union(docs)
    assert sorted(map(repr, map(tuple, nd.keep_first(copies).collect()))) == sorted(map(repr, got))


def test_prefixes_hold_all_similar_pairs(spark):
    rng = random.Random(4)
    sets = []
    for _ in range(12):
        base = [rng.randrange(1 << 52) for _ in range(rng.randrange(4, 40))]
        for _ in range(6):
            mine = set(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 4))):
                mine.discard(rng.choice(base))
                if rng.random() < 0.5:
                    mine.add(rng.randrange(1 << 52))
            sets.append(sorted(mine))
    rows = [(i, i if i % 3 else i - i % 6, s) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "key bigint, c bigint, elements array<bigint>").repartition(3)
    got = {tuple(r) for r in prefix_join.candidates(df, 80).collect()}
    near = {(a, b) for a, ac, x in rows for b, bc, y in rows if a < b and ac != bc and 100 * len(set(x) & set(y)) >= 80 * len(set(x) | set(y))}
    assert near and near <= got and all(a < b and rows[a][1] != rows[b][1] for a, b in got)


def test_templates_below_the_similarity_hardly_meet(spark, monkeypatch):
    """600 documents of one template share bands by the dozen, are no near copies, and are not compared with each other."""
    template = [f"t{i}" for i in range(120)]
    rows = [(i, " ".join(template + [f"own{i}x{k}" for k in range(20)])) for i in range(600)]
    asked, compared = [], nd.confirm

    def count(pairs, full, percent):
        asked.append(pairs.count())
        return compared(pairs, full, percent)

    monkeypatch.setattr(nd, "confirm", count)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = nd.near_duplicates(docs, words=1).collect()
    assert all(r.component_id == r.doc_id for r in got)
    assert sum(asked) < 5 * len(rows)


def plain_superminhash(elements):
    """The published loop, one element after another, with the same random numbers."""
    m = nd.SLOTS
    slots = [2**64 - 1] * m
    for e in mix(np.array(elements, dtype=np.uint64)):
        order = list(range(m))
        for rank in range(m):
            r = int(mix(np.array([(int(e) + (rank + 1) * nd._GOLDEN) % 2**64], dtype=np.uint64))[0])
            k = rank + ((r & 0xFFFFFFFF) * (m - rank) >> 32)
            order[rank], order[k] = order[k], order[rank]
            slots[order[rank]] = min(slots[order[rank]], rank << 32 | r >> 32)
    return slots


def test_signatures_against_the_plain_loop():
    sets = [[5, 9, 77, 1234], list(range(100, 120))]
    elements = np.array(sum(sets, []), dtype=np.uint64)
    got = nd.signatures(elements, np.repeat([0, 1], [4, 20]), 2)
    assert got[0].tolist() == plain_superminhash(sets[0]) and got[1].tolist() == plain_superminhash(sets[1])


def test_signatures_estimate_similarity_with_less_spread():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(60):
        e = rng.integers(0, 2**63, 60, dtype=np.uint64)
        pair = np.concatenate([np.sort(e[:40]), np.sort(e[20:])])
        got = nd.signatures(pair, np.repeat([0, 1], 40), 2)
        errors.append((got[0] == got[1]).mean() - 1 / 3)
    spread = np.sqrt(1 / 3 * 2 / 3 / nd.SLOTS)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.9 * spread


def test_packed_bits_hold_two_bits_of_each_slot():
    slots = np.random.default_rng(3).integers(0, 2**63, (2, nd.SLOTS), dtype=np.uint64)
    packed = nd.packed_bits(slots)
    assert packed.shape == (2, nd.WORDS)
    for s in (0, 1, 31, 32, nd.SLOTS - 1):
        assert int(packed[1, s // nd.PACKED]) >> 2 * (s % nd.PACKED) & 3 == int(slots[1, s]) & 3


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    random.Random(5).shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint").repartition(5)).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}
    in_rounds = components(spark.createDataFrame(links, "a bigint, b bigint").repartition(5), one_task=-1).collect()
    assert {r.node: r.component for r in in_rounds} == got
    for most in (-1, 10):
        assert components(spark.createDataFrame([], "a bigint, b bigint"), one_task=most).count() == 0


def test_sketch_does_not_depend_on_slices(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string")
    whole = {r.doc_id: (r.set_a, r.set_b, r.bands) for r in nd.sketch(docs.coalesce(1), 2).collect()}
    split = {r.doc_id: (r.set_a, r.set_b, r.bands) for r in nd.sketch(docs.repartition(7), 2).collect()}
    assert whole == split and isinstance(next(iter(whole.values()))[2], list)


def test_pairs_of_unlike_sketches_make_no_row_in_a_slot(spark):
    from pyspark.sql import functions as F

    elements = {k: [*range(20), 100 + k] for k in range(6)}
    df = spark.createDataFrame([(k, k, e) for k, e in elements.items()], "key long, c long, elements array<long>")
    marks = spark.createDataFrame([(k, [k % 2]) for k in elements], "key long, bits array<long>")
    alike = F.col("abits")[0] == F.col("bbits")[0]
    got = {tuple(r) for r in prefix_join.candidates(df, 80, marks, alike).collect()}
    every = {tuple(r) for r in prefix_join.candidates(df, 80).collect()}
    assert got == {(a, b) for a, b in every if a % 2 == b % 2} and len(every) == 15
