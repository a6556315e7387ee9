import tracemalloc

import numpy as np

from folioworks.llm import toxicity, words


def labelled(n, length=1200):
    """Texts of equal length out of the same 3,000 words; every other one has an insult."""
    rng = np.random.default_rng(5)
    known = ["".join(chr(97 + c) for c in rng.integers(0, 26, 7)) for _ in range(3000)]
    texts = [" ".join(rng.choice(known, length)) + (" numbskull" if i % 2 else "") for i in range(n)]
    return texts, np.arange(n) % 2


def peak(texts, labels):
    tracemalloc.start()
    try:
        toxicity.learn(texts, labels)
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_the_fit_does_not_hold_arrays_of_all_texts():
    toxicity.learn(*labelled(20))
    less, more = labelled(120), labelled(480)
    grown = peak(*more) - peak(*less)
    assert grown < 10 * (sum(map(len, more[0])) - sum(map(len, less[0])))


def test_a_long_text_leaves_no_powers_behind():
    up, down = words.powers(3 * words.SLICE_BYTES)
    assert len(up) == len(down) == 3 * words.SLICE_BYTES and np.all(up * down == 1)
    few, _ = words.powers(1000)
    assert np.array_equal(few, up[:1000])
    assert sum(x.nbytes for x in words._powers.values()) < 2.5 * 8 * words.SLICE_BYTES


def test_words_of_slices_are_those_of_the_whole():
    texts = [t.encode() for t in labelled(260)[0]] + [b"", b"a", b"i d i o t", b"x" * words.SLICE_BYTES, b"numbskull"]
    assert sum(map(len, texts)) > 3 * words.SLICE_BYTES
    found, doc, word = toxicity.vocabulary(texts)
    whole = toxicity.Words(texts)
    keys, place, back = np.unique(whole.keys(), return_index=True, return_inverse=True)
    assert np.array_equal(found.keys(), keys)
    assert np.array_equal(found.stream, whole.picked(place).stream)
    pair = np.unique(whole.doc * len(keys) + back)
    assert sorted(zip(doc.tolist(), word.tolist(), strict=True)) == [divmod(x, len(keys)) for x in pair.tolist()]
    assert np.all(np.diff(doc) >= 0)
    for few in ([], [b""], [b"", b". !"]):
        none, doc, word = toxicity.vocabulary(few)
        assert not len(none.start) and not len(doc) and not len(word)


def test_steps_of_the_evidence_do_not_matter(monkeypatch):
    texts, labels = labelled(40, 60)
    one = toxicity.learn(texts, labels)
    monkeypatch.setattr(toxicity, "EVIDENCE_STEP", 1)
    two = toxicity.learn(texts, labels)
    assert np.array_equal(one.table, two.table) and (one.bias, one.slope, one.offset) == (two.bias, two.slope, two.offset)
