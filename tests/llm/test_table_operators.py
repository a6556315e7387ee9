import gzip
import hashlib
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioworks.llm import labelled, neighbours, page_language, perspectives, sharding, warc


# -- WARC


def test_archives_hold_one_member_per_record(spark, tmp_path):
    big = "é" * 600
    rows = [(5, "http://a/b c", big), (9, None, big), (7, "http://x\r\ny", big), (1, "u", "small"), (2, "u", "small"), (3, "u", None), (None, "u", big), (-4, "u", "z" * 5000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1))
    folder = str(tmp_path)
    archives = warc.write(warc.with_revisits(pages).repartition(2), folder)
    records = warc.read(archives, folder).collect()
    assert len(records) == len(rows)
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in records}
    assert kinds == {9: ("response", None), 5: ("revisit", 9), 7: ("revisit", 9), None: ("revisit", 9), **{k: ("response", None) for k in (1, 2, 3, -4)}}
    html = {i: (h or "").encode() for i, _, h in rows}
    for r in records:
        assert r.payload_bytes == len(html[r.page_id]) and r.payload_digest == hashlib.sha1(html[r.page_id]).hexdigest()
        assert r.payload == (html[r.page_id] if r.record_type == "response" else None)
    files = list(Path(folder).glob("*.warc.gz"))
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert whole.count(b"WARC/1.1\r\n") == len(rows) and sum(f.read_bytes().count(b"\x1f\x8b\x08") for f in files) >= len(rows)
    assert whole.count(b"WARC-Type: revisit") == 3


def test_reader_checks_what_it_reads():
    good = warc.record(3, "http://a", b"hello", None)
    for chunk in (1, 7, 10_000):
        data = good + warc.record(4, None, b"", 3)
        parts = iter([data[i : i + chunk] for i in range(0, len(data), chunk)])
        assert [warc.parse(m)["page_id"] for m in warc.members(parts)] == [3, 4]
    content = gzip.decompress(good)
    for bad in (content.replace(b"hello", b"hellO"), content[:-1], content + b"x", b"no record"):
        with pytest.raises(ValueError):
            warc.parse(bad)
    with pytest.raises(ValueError):
        list(warc.members(iter([good[:-20]])))
    with pytest.raises(zlib.error):
        list(warc.members(iter([b"not gzip at all"])))


def test_rolling_and_empty_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ROLL_BYTES", 2000)
    pages = spark.range(50).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("text "), F.col("id")).alias("html"))
    archives = warc.write(warc.with_revisits(pages).coalesce(1), str(tmp_path))
    assert warc.read(archives, str(tmp_path)).count() == 50
    none = warc.write(warc.with_revisits(pages.limit(0)), str(tmp_path / "none"))
    assert warc.read(none, str(tmp_path / "none")).count() == 0


# -- sharding


def plain_jump(key, n):
    b, j = -1, 0
    key &= 2**64 - 1
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_against_the_published_loop():
    keys = [0, 1, 2, 12345, -1, -77, 2**63 - 1, *random.Random(1).sample(range(10**12), 300)]
    array = np.array(keys, dtype=np.int64).view(np.uint64)
    for n in (1, 2, 16, 17, 1000):
        assert sharding.jump(array, n).tolist() == [plain_jump(k, n) for k in keys]


def test_shards_have_gapless_slots_and_grow_by_moving_in(spark, odd_docs, no_docs, table):
    docs = table("documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = sharding.place(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        assert (r.shard, r.grown_shard) == (plain_jump(r.doc_id, 16), plain_jump(r.doc_id, 17))
        assert r.grown_shard in (r.shard, 16)
    for s in range(16):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    odd = sharding.place(odd_docs).collect()
    assert len(odd) == odd_docs.count() and {(r.size, r.text_crc32) for r in odd if r.doc_id in (1, 2)} == {(1, 0)}
    assert {r.shard for r in odd if r.doc_id is None} == {plain_jump(0, 16)}
    assert sharding.place(no_docs).count() == 0


# -- neighbours


def exact(x, ids, k):
    out = {}
    for n, i in enumerate(ids):
        if i % 20 == 0:
            scores = [(-(x[n] * x[m]).sum(), j) for m, j in enumerate(ids) if j != i]
            out[i] = [(j, -s) for s, j in sorted(scores)[:k]]
    return out


def test_recall_and_scores_on_given_vectors(table):
    vectors = table("embeddings", "/root/testdata/sf0.01")
    rows = vectors.orderBy("vec_id").collect()
    x, ids = np.array([r.embedding for r in rows], dtype=float), [r.vec_id for r in rows]
    want = exact(x, ids, 20)
    place = {i: n for n, i in enumerate(ids)}
    got = {}
    for r in neighbours.nearest(vectors, vectors.filter("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hit = sum(len({v for _, v, _ in got[i]} & {v for v, _ in want[i]}) for i in want)
    assert hit >= 0.9 * sum(map(len, want.values()))
    for i, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(abs(s - (x[place[i]] * x[place[v]]).sum()) < 1e-12 for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)


def test_odd_vectors_ties_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK", 7)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 5)).round(2).tolist()
    rows = [(i, v) for i, v in enumerate(base)] + [(100 + i, base[3]) for i in range(60)]
    rows += [(500, None), (501, [0.0] * 5), (502, [1.0, None, 0.0, 0.0, 0.0]), (503, [float("nan")] * 5), (504, [float("inf")] * 5), (505, [1.0, 2.0]), (None, base[0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("list", F.lit(0))
    got = {}
    for r in neighbours.nearest(vectors, vectors.filter("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    x, ids = np.array([v for _, v in rows[:100]], dtype=np.float32).astype(float), [i for i, _ in rows[:100]]
    want = exact(x, ids, 20)
    assert {q: [v for _, v in sorted(f)] for q, f in got.items()} == {q: [v for v, _ in f] for q, f in want.items()}
    assert neighbours.nearest(vectors.limit(0), vectors).count() == 0
    few = vectors.filter("vec_id IN (0, 1, 2)")
    assert [(r.query_id, r.rank) for r in neighbours.nearest(few, few.filter("vec_id = 0")).orderBy("rank").collect()] == [(0, 1), (0, 2)]


@pytest.mark.parametrize("list_size, most_lists", [(128, 2000), (8, 2000)])
def test_small_isolated_groups_have_all_ranks(spark, monkeypatch, list_size, most_lists):
    """Groups of ten near copies far from all else, at few lists and at the most lists."""
    monkeypatch.setattr(neighbours, "LIST_SIZE", list_size)
    rng = np.random.default_rng(8)
    loose, heads = rng.normal(size=(16_000, 12)), rng.normal(size=(40, 12))
    x = np.concatenate([loose, np.repeat(heads, 10, axis=0) + 1e-6 * rng.normal(size=(400, 12))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.arange(len(x))
    vectors = spark.createDataFrame([(int(i), v) for i, v in zip(ids, x.tolist(), strict=True)], "vec_id bigint, embedding array<double>")
    asked = np.arange(16_000, 16_400, 4).tolist()
    got = {}
    for r in neighbours.nearest(vectors, vectors.filter(F.col("vec_id").isin(asked))).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert {q: len(v) for q, v in got.items()} == dict.fromkeys(asked, 20)
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :20]
    assert np.mean([len(got[q] & set(b.tolist())) / 20 for q, b in zip(asked, best, strict=True)]) >= 0.9


def test_rows_of_one_id_do_not_crowd_out_others(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(50, 5)).tolist()
    rows = [(i, v) for i, v in enumerate(base)] + [(1, base[0])] * 100
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r.rank: r.vec_id for r in neighbours.nearest(vectors, vectors.filter("vec_id = 0")).collect()}
    want = dict.fromkeys([1] + [j for j in np.argsort(-(np.array(base) @ np.array(base[0])), kind="stable").tolist() if j > 1])
    x, best = np.array(base), {}
    for i, v in rows:
        if i:
            best[i] = max(best.get(i, -np.inf), float(np.dot(x[0], v)))
    order = sorted(want, key=lambda i: (-best[i], i))[:20]
    assert [got[r] for r in range(1, 21)] == order


def test_queries_short_of_rows_search_all_lists(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BEAM", 1)
    monkeypatch.setattr(neighbours, "LIST_SIZE", 4)
    x = np.random.default_rng(10).normal(size=(200, 6))
    vectors = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    got = neighbours.nearest(vectors, vectors.filter("vec_id < 20")).groupBy("query_id").count().collect()
    assert len(got) == 20 and {r["count"] for r in got} == {20}


def test_graph_search_finds_near_centroids():
    rng = np.random.default_rng(2)
    c = neighbours.Centroids(rng.normal(size=(500, 12)))
    q = rng.normal(size=(50, 12))
    ids, dist = c.search(q, 40)
    real = np.sqrt(((q[:, None, :] - c.points[None]) ** 2).sum(2))
    best = np.argsort(real, axis=1)[:, :10]
    assert np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(ids, best, strict=True)]) > 0.95
    assert np.allclose(dist, np.take_along_axis(real, ids, 1))


# -- page language


def test_languages_of_given_pages(table):
    rows = page_language.identify(table("pages"), table("documents")).collect()
    assert len(rows) == table("pages").count()
    assert np.mean([r.lang == r.declared for r in rows if r.declared]) > 0.97
    assert all(0 < r.confidence <= 1 + 1e-9 for r in rows)


def test_fusion_against_plain_sums(spark):
    """Pages without text: all evidence is counted, so the posterior can be worked out by hand."""
    texts = [(i, "der die und nicht mit ein", "de") for i in range(6)] + [(10 + i, "the and with not from this", "en") for i in range(6)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string")
    page = lambda i, host, lang, text: (i, f"https://{host}/a", f'<html lang="{lang}"><p>{text}</p></html>' if lang else f"<p>{text}</p>")
    rows = [page(i, "www.a.de", "de", "der die und nicht") for i in range(5)] + [page(10 + i, "b.com", "en", "the and with not") for i in range(4)]
    rows += [page(20, "www.a.de", None, ""), page(21, "b.com", "de", ""), page(22, "x.a.de", None, ""), (23, None, None), (None, "http://b.com", None)]
    got = {r.page_id: r for r in page_language.identify(spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("best", F.lit(9)), docs).collect()}
    assert got[20].lang == "de" and got[22].lang == "de" and got[None].lang == "en" and got[20].text_lang is None
    share = {"de": (5 + 1) / (9 + 2), "en": (4 + 1) / (9 + 2)}
    w = page_language.WEIGHT
    domain = {k: ({"de": 0, "en": 4}[k] + w * share[k]) / (4 + w) for k in share}
    prior = {k: ({"de": 0, "en": 4}[k] + w * domain[k]) / (4 + w) for k in share}
    declared = {"de": (5 + 1) / (5 + 2 + 1), "en": (0 + 1) / (4 + 2 + 1)}
    suffix = {"de": (0 + 1) / (5 + 2 + 1), "en": (4 + 1) / (4 + 2 + 1)}
    p = {k: prior[k] * declared[k] * suffix[k] for k in share}
    best = max(p, key=p.get)
    assert got[21].lang == best and abs(got[21].confidence - p[best] / sum(p.values())) < 1e-9
    assert got[23].lang == "de" and abs(got[23].confidence - share["de"]) < 0.2


def test_rare_suffixes_and_languages_count_too(spark):
    """More than 1,000 suffixes and 200 languages, and one language with most of the texts."""
    texts = [(i, "the and with not from this", "en") for i in range(7000)] + [(10_000 + i, f"{chr(0x4E00 + i)}xyz" * 5, f"l{i:03d}") for i in range(210)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string")
    languages, logs = page_language.fit_text(docs)
    assert languages == sorted({lang for _, _, lang in texts}) and len(logs) == 211
    fitted = spark.createDataFrame([t for t in texts if t[2] in ("en", "l001")], docs.schema)
    words = {"en": "the and with not", "l001": texts[7001][1]}
    page = lambda i, host, text: (i, f"https://{host}/a", f"<p>{text}</p>")
    rows = [page(10 * i + j, f"h{j}.s{i:04d}", words["en"]) for i in range(1001) for j in range(3)]
    rows += [page(50_000 + j, f"h{j}.zz", words["l001"]) for j in range(2)] + [page(60_000, "other.zz", "")]
    got = {r.page_id: r for r in page_language.identify(spark.createDataFrame(rows, "page_id bigint, url string, html string"), fitted).collect()}
    share = {"en": (3003 + 1) / (3005 + 2), "l001": (2 + 1) / (3005 + 2)}
    suffix = {"en": 1 / (3003 + 1002 + 1), "l001": (2 + 1) / (2 + 1002 + 1)}
    p = {k: share[k] * suffix[k] for k in share}
    best = max(p, key=p.get)
    assert got[60_000].lang == best and abs(got[60_000].confidence - p[best] / sum(p.values())) < 1e-9
    assert len(got) == len(rows)


def test_pages_without_rows_or_labels(spark, table, no_docs):
    pages = table("pages")
    assert page_language.identify(pages.limit(0), table("documents")).count() == 0
    rows = page_language.identify(pages, no_docs).collect()
    assert len(rows) == pages.count() and {r.lang for r in rows} == {None}


# -- perspectives


def render(rows):
    """The whole dialogue for each speaker, and the characters to learn from."""
    turns = sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], r[2] is not None, r[2] or "", r[3] or ""))
    out = {}
    for s in {r[2] for r in rows if r[2] not in (None, "system")}:
        text, learned = "", ""
        for _, _, role, words in turns:
            name = "assistant" if role == s else "system" if role == "system" else "user" if role is None else f"user name={role}"
            text += f"<|im_start|>{name}\n"
            if role == s:
                learned += (words or "") + "<|im_end|>"
            text += (words or "") + "<|im_end|>\n"
        out[s] = (text, learned)
    return out


def test_perspectives_against_plain_rendering(spark):
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["ann", "bob", "eve", "system"]), rng.choice(["hi", "é\nso", "", "why?"])) for c in range(6) for t in range(rng.randrange(1, 150))]
    rows += [(50, 1, None, "x"), (50, None, "ann", None), (50, 2, "bob", "y"), (50, 2, "bob", "y"), (51, 0, "system", "s"), (None, 0, "ann", "lost")]
    got = {}
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("speaker", F.lit("z"))
    for r in perspectives.perspectives(table).collect():
        got.setdefault((r.conv_id, r.speaker), []).append(r)
    want = {(c, s): v for c in {r[0] for r in rows} - {None} for s, v in render([r for r in rows if r[0] == c]).items()}
    assert got.keys() == want.keys() and max(map(len, got.values())) > 1
    for key, blocks in got.items():
        blocks.sort(key=lambda r: r.block)
        text = "".join(r.text for r in blocks)
        assert text == want[key][0]
        assert [r.text_start for r in blocks] == [sum(len(b.text) for b in blocks[:k]) for k in range(len(blocks))]
        assert "".join(r.text[m.start : m.end] for r in blocks for m in r.mask) == want[key][1]
    assert perspectives.perspectives(table.limit(0)).count() == 0


def test_large_small_and_odd_vectors_lose_nothing(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    # queries of another length than most vectors take no part, and do no harm
    odd = [(1000 + 20 * i, [1.0, 2.0]) for i in range(30)]
    for factor in (1e200, 1e-200, 1.0):
        scaled = [(i, (np.array(v) * (factor if i == 40 else 1.0)).tolist()) for i, v in rows] + odd
        df = spark.createDataFrame(scaled, "vec_id bigint, embedding array<double>")
        got = {}
        for r in neighbours.nearest(df, df.filter("vec_id % 20 = 0"), 20).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        assert sorted(got) == list(range(0, 300, 20)) and all(len(v) == 20 for v in got.values())
        vectors = {i: np.array(v) for i, v in scaled if i < 1000}
        for q, found in got.items():
            for rank, i, score in found:
                exact = float((vectors[q] * vectors[i]).sum())
                assert score == pytest.approx(exact, rel=1e-12) if i != 40 and q != 40 else True
            assert [s for _, _, s in sorted(found)] == sorted((s for _, _, s in found), reverse=True)
        if factor == 1e200:
            # the long vector is the best or the worst of all for every query
            for q, found in got.items():
                dot = float((vectors[q] * vectors[40]).sum())
                assert q == 40 or (40 in {i for _, i, _ in found}) == (dot > 0)


def test_samples_do_not_depend_on_copies(spark):
    docs = [(i, f"text {i}") for i in range(60)]
    labels = [(i, i % 2, 0) for i in range(60)] + [(7, 0, 0)]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    plain = sorted(map(tuple, labelled.sample(frame(docs), marks, "quality", 20).collect()))
    assert len(plain) == 20 and sum(r[2] for r in plain) == 10 and all(r[0] != 7 for r in plain)
    some = [r for r in docs if r[0] == plain[0][0]]
    for copied in (some * 3000 + docs, docs + some * 3000):
        assert sorted(map(tuple, labelled.sample(frame(copied), marks, "quality", 20).collect())) == plain
    twice = docs + [(plain[0][0], f"another text {k}") for k in range(50)]
    assert len(labelled.sample(frame(twice), marks, "quality", 20).collect()) == 20
