import hashlib
import random
import struct

import numpy as np
import pyarrow as pa
import pytest

from folioworks.llm import byte_bpe, decontaminate
from folioworks.llm.words import Tokens, distinct, ngrams, slices

PATH_NAME = "byte_bpe_multi_50k.tiktoken"


def test_tokens_against_split():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aB é\t\n\r\x0b\x0c .") for _ in range(rng.randrange(0, 30))).encode() for _ in range(200)]
    tokens = Tokens(texts)
    got = [[] for _ in texts]
    for a, b, d in zip(tokens.start, tokens.end, tokens.doc, strict=True):
        got[d].append(tokens.data[a:b].tobytes())
    assert got == [t.lower().split() for t in texts]
    hashes, seen = tokens.hashes(), {}
    for h, a, b in zip(hashes.tolist(), tokens.start, tokens.end, strict=True):
        assert seen.setdefault(tokens.data[a:b].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)
    grams, of = ngrams(hashes, tokens.doc, tokens.first, 3)
    once, once_of = distinct(grams, of)
    want = [len({tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else ()) for w in got]
    assert np.bincount(once_of, minlength=len(texts)).tolist() == want


def test_slices_are_whole_texts():
    texts = pa.array(["a" * 10, None, "b" * 100, "", "c"])
    parts = list(slices(texts, size=20))
    assert [x for _, p in parts for x in p] == [b"a" * 10, b"", b"b" * 100, b"", b"c"]
    assert [f for f, _ in parts] == [0, 2, 3]


# -- decontamination


def made_benchmark():
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ro") for b in ("ta", "so", "vi", "du", "ge")]
    sentence = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(5, 14))).capitalize() + "."
    items = [" ".join(sentence() for _ in range(rng.randrange(2, 5))) for _ in range(60)] + [" ".join(sentence() for _ in range(40))]
    noise = lambda k: " ".join(rng.choice(words) for _ in range(k))
    texts = [noise(rng.randrange(0, 700)) for _ in range(40)]
    for i in range(0, 61, 3):
        texts.append(noise(rng.randrange(0, 300)) + " " + items[i] + " " + noise(rng.randrange(0, 300)))
    half = items[5].split(". ")[0] + "."
    return list(enumerate(items)), [*texts, "start " + half + " end", items[7].upper().replace(" ", "\n")]


def bm25(units, queries):
    """Every score of every unit, from the formula, relative to the unit's own."""
    k1, b = decontaminate.K1, decontaminate.B
    mean = np.mean([len(u) for u in units])
    df = {}
    for u in units:
        for w in set(u):
            df[w] = df.get(w, 0) + 1

    def score(q, u):
        total = 0.0
        for w in set(q) & set(u):
            tf, idf = u.count(w), np.log(1 + (len(units) - df[w] + 0.5) / (df[w] + 0.5))
            total += idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(u) / mean))
        return total

    own = [score(u, u) for u in units]
    return [[score(q, u) / o for u, o in zip(units, own, strict=True)] for q in queries]


@pytest.mark.parametrize("threshold", [0.6, 0.35])
def test_retrieval_against_all_scores(threshold):
    items, texts = made_benchmark()
    index = decontaminate.build_index(items)
    step, size = decontaminate.STEP, decontaminate.PASSAGE
    plain = lambda t: decontaminate.plain([t.encode()])[0].lower().decode().split()
    units, of = [], []
    for i, t in items:
        w = plain(t)
        units += [w[k : k + step] for k in range(0, len(w), step)]
        of += [i] * len(units[len(of) :])
    want = {}
    for d, text in enumerate(texts):
        w = plain(text)
        passages = [w[k : k + size] for k in range(0, max(1, len(w) - step), step)]
        for row in bm25(units, passages):
            for u, s in enumerate(row):
                if s >= threshold:
                    want[d, of[u]] = max(s, want.get((d, of[u]), 0))
    tokens = Tokens(decontaminate.plain([t.encode() for t in texts]))
    got = {(d, i): s for d, i, s in decontaminate.retrieve(index, tokens, tokens.hashes(), threshold)}
    assert got.keys() == want.keys() and len(got) > 20
    assert np.allclose([got[k] for k in got], [want[k] for k in got])


def test_leaks_are_found_and_confirmed(spark):
    items, texts = made_benchmark()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.leaks(docs, benchmark).collect()
    want = {(40 + n, i) for n, i in enumerate(range(0, 61, 3))} | {(len(texts) - 1, 7)}
    assert {(r.doc_id, r.item_id) for r in rows} == want
    assert all(r.question_overlap >= 0.7 and r.answer_overlap >= 0.7 for r in rows)
    kept = {r.doc_id for r in decontaminate.drop_leaks(docs, benchmark).collect()}
    assert kept == set(range(len(texts))) - {d for d, _ in want}


def test_several_indexes_find_the_same(spark, monkeypatch):
    items, texts = made_benchmark()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    one = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()}
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 4000)
    assert len(decontaminate.indexes(benchmark)) > 2
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()} == one


def test_odd_rows_of_decontamination(spark, odd_docs, no_docs):
    odd_items = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (None, "no id here"), (4, "one")], "item_id bigint, text string")
    got = sorted((r.doc_id or -1, r.item_id or -1) for r in decontaminate.leaks(odd_docs, odd_items).collect())
    assert got == [(-1, -1), (4, 4), (4, 4), (5, 4), (6, 4)]
    kept = decontaminate.drop_leaks(odd_docs, odd_items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 5
    assert decontaminate.leaks(no_docs, odd_items).count() == 0
    assert decontaminate.leaks(odd_docs, odd_items.limit(0)).count() == 0
    assert decontaminate.drop_leaks(odd_docs, odd_items.limit(0)).count() == odd_docs.count()


def test_question_and_answer():
    assert decontaminate.question_and_answer("What is it? One.\nTwo! ") == ("What is it? One.", "Two!")
    assert decontaminate.question_and_answer("only one") == ("only one", "only one")


# -- byte-level BPE


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    table = byte_bpe.ranks(public_tokenizers.path(PATH_NAME))
    return table, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table.ids, special_tokens={})


def test_ids_against_the_library(library):
    table, encoding = library
    rng = random.Random(7)
    signs = [*"ab'stremdlv''  \n\t\r123٣é漢字ñ¿?!.,_-  😀²ǅ", "'ll", "'re", "'ve", "'s ", " 't", "  ", "<|endoftext|>"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(0, 50))) for _ in range(1500)]
    texts += ["", "a" * 4000, "ab" * 700, "é" * 300, " " * 200, "Don't 'S we'lL it''s", "x's\n's 's"]
    ids, first = byte_bpe.encode_texts(table, [t.encode() for t in texts])
    for k, text in enumerate(texts):
        assert ids[first[k] : first[k + 1]].tolist() == encoding.encode_ordinary(text), text


def test_given_documents_against_the_library(spark, library, table):
    ranks, encoding = library
    import public_tokenizers

    docs = table("documents")
    path = public_tokenizers.path(PATH_NAME)
    got = {r.doc_id: r for r in byte_bpe.tokenize(docs, path, ["doc_id"], list(byte_bpe.FIELDS)).collect()}
    for r in docs.collect():
        ids = encoding.encode_ordinary(r.text or "")
        made = got[r.doc_id]
        assert made.ids == ids and made.n_tokens == len(ids) and made.decoded == (r.text or "")
        assert made.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert made.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_both_ways_to_fold_and_a_small_memory(library, monkeypatch):
    table, _ = library
    rng = random.Random(2)
    pieces = ["".join(rng.choice("thionerds é") for _ in range(rng.randrange(2, 60))).encode() for _ in range(400)]
    assert all(table._fold(p) == table._fold_long(p) for p in pieces)
    monkeypatch.setattr(byte_bpe, "CACHE_WORDS", 10)
    again = [np.frombuffer(table.encode(p), dtype=np.uint32).tolist() for p in pieces + pieces]
    assert again[:400] == again[400:] and len(table.recent) <= 10 + len(pieces)


def test_odd_rows_of_bpe(odd_docs, no_docs):
    import public_tokenizers

    path = public_tokenizers.path(PATH_NAME)
    rows = byte_bpe.tokenize(odd_docs, path, ["doc_id"], ["n_tokens", "decoded", "ids_sha256"]).collect()
    assert len(rows) == odd_docs.count()
    texts = {r.doc_id: r.text or "" for r in odd_docs.filter("doc_id <> 9").collect()}
    assert all(r.decoded == texts[r.doc_id] for r in rows if r.doc_id in texts)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    assert byte_bpe.tokenize(no_docs, path, ["doc_id"], ["n_tokens"]).count() == 0
