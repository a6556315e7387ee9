import zlib

import numpy as np
import pytest

from folioworks.llm import quality, toxicity
from folioworks.llm.labelled import without_copies

SF01 = "/root/testdata/sf0.01"


def out_of_training(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    return docs, spark.read.parquet(f"{SF01}/labels.parquet")


def test_quality_on_held_out_labels(labelled):
    docs, labels = labelled
    trees = quality.fit(docs, labels)
    scores = {r.doc_id: r.score for r in quality.score_quality(docs, trees).collect()}
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores.values())
    held = [(scores[r.doc_id] >= 0.5) == (r.quality == 1) for r in labels.collect() if out_of_training(r.doc_id)]
    assert np.mean(held) > 0.97


def test_toxicity_on_held_out_labels(labelled):
    docs, labels = labelled
    machine = toxicity.fit(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, machine).collect()}
    held = [(scores[r.doc_id] >= 0.7, r.toxic == 1) for r in labels.collect() if out_of_training(r.doc_id)]
    assert np.mean([a == b for a, b in held]) > 0.93


def test_labels_of_held_out_rows_do_not_matter(spark, labelled):
    from pyspark.sql import functions as F

    from folioworks.llm.labelled import held_out

    docs, labels = labelled
    twisted = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = quality.fit(docs, labels), quality.fit(docs, twisted)
    assert np.array_equal(one.limit, two.limit) and np.array_equal(one.value, two.value)


def test_trees_walk_as_rules_do():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(600, 4))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 2] > 0.5)).astype(float)
    trees = quality.grow(rows, labels)

    def walk(row):
        total = trees.start
        for node in trees.roots:
            for _ in range(quality.DEPTH):
                node = trees.left[node] if row[trees.feature[node]] <= trees.limit[node] else trees.right[node]
            total += trees.value[node]
        return total

    assert np.allclose(trees.margin(rows[:50]), [walk(r) for r in rows[:50]])
    assert np.mean((trees.score(rows) >= 0.5) == labels) > 0.97


def test_statistics_of_a_small_text():
    got = dict(zip(quality.STATISTICS, quality.statistics([b"Aa bb. aa\naa 12!", b""])[0], strict=True))
    assert np.isclose(got["log_words"], np.log1p(5)) and np.isclose(got["log_lines"], np.log1p(2))
    assert np.isclose(got["upper"], 1 / 8) and np.isclose(got["digits"], 2 / 16) and np.isclose(got["marks"], 2 / 16)
    assert np.isclose(got["words_without_letter"], 1 / 5) and np.isclose(got["distinct_words"], 4 / 5)
    assert np.isclose(got["top_word"], 2 / 5) and np.isclose(got["sentence_ends"], 2 / 5)
    assert np.all(quality.statistics([b""]) == 0)


def by_subsequences(x, y):
    """The kernel of two words by listing subsequences."""

    def features(word):
        out, square = {}, 0.0
        s = "^" + word
        for i in range(len(s)):
            for a in range(1, toxicity.GAPS + 1):
                for b in range(1, toxicity.GAPS + 1):
                    if i + a + b < len(s):
                        w = toxicity.DECAY ** (a + b - 2)
                        key = s[i] + s[i + a] + s[i + a + b]
                        out[key] = out.get(key, 0) + w
                        square += w * w
        return out, square**0.5

    (f, m), (g, n) = features(x), features(y)
    return sum(v * g.get(k, 0) for k, v in f.items()) / (m * n)


def test_kernel_against_listed_subsequences():
    names = ["idiot", "idxiot", "idiom", "banana", "loser", "iiii"]
    words = toxicity.Words([" ".join(names).encode()])
    kernel = toxicity.Kernel(words.picked(np.arange(len(names))))
    table = np.zeros(toxicity.SYMBOLS**3)
    for i, x in enumerate(names):
        assert np.allclose(kernel.column(i, table), [by_subsequences(x, y) for y in names])
    assert by_subsequences("idiot", "idxiot") > 0.4 > by_subsequences("idiot", "banana")


def test_words_join_letters_and_drop_signs():
    def words(text):
        w = toxicity.Words([text.encode()])
        return ["".join(chr(96 + c) if c < 27 else "#" for c in w.stream[a + 1 : b]) for a, b in zip(w.start, w.end, strict=True)]

    assert words("you i d i o t !") == ["you", "idiot"]
    assert words("an i.d.i-o*t, A B") == ["an", "idiot", "ab"]
    assert words("a\n\nfool") == ["fool"]


def test_insults_with_gaps():
    rng = np.random.default_rng(4)
    common = ["river", "table", "winter", "garden", "letter", "mountain", "bright", "carry", "follow", "simple"]
    texts, labels = [], []
    for i in range(240):
        words = list(rng.choice(common, 12)) + [f"{a}{b}" for a, b in rng.choice(common, (6, 2))]
        if i % 2:
            words.insert(int(rng.integers(len(words))), "numbskull")
        texts.append(" ".join(words)), labels.append(i % 2)
    machine = toxicity.learn(texts, np.array(labels))
    shown = ["what a numbskull", "n.u.m.b.s.k.u.l.l", "n u m b s k u l l", "numb-skull", "numbxskull", "such a garden table", ""]
    score = machine.score([t.encode() for t in shown])
    assert (score[:5] >= 0.7).all() and (score[5:] < 0.3).all()


@pytest.mark.parametrize("module, call", [(quality, "score_quality"), (toxicity, "score_toxicity")])
def test_odd_rows(spark, odd_docs, no_docs, labelled, module, call):
    docs, labels = labelled
    model = module.fit(docs, labels)
    score = getattr(module, call)
    rows = score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (4, 5, 6)}) == 1
    assert score(no_docs, model).count() == 0
    kept = module.keep_good(odd_docs, model, 0.0) if module is quality else module.keep_clean(odd_docs, model, 1.1)
    assert kept.columns == odd_docs.columns and sorted(map(repr, kept.collect())) == sorted(map(repr, odd_docs.collect()))
    for few in (labels.limit(0), labels.filter("quality = 1 AND toxic = 0")):
        assert len({r.score for r in score(odd_docs, module.fit(docs, few)).collect()}) == 1


def test_near_copies_count_once():
    base = [f"word{i} other{i} third{i}" for i in range(40)]
    text = " ".join(base)
    near = " ".join([*base[:-1], "changed end"])
    assert without_copies([text, near, "something else entirely here", text]).tolist() == [0, 2]
