import random

from pyspark.sql import functions as F

from folioworks.functions import text as X

PIECES = [
    "page 3", "Page 3 of 9", "12", "3 / 4", "第 5 頁", "Seite 2/3", "PÁGINA 4 de 5", "SAYFA 1", "٣", "", "Bar.",
    "- x", "•", "• y", "[x] done", "[ ]", "[ ] ", "---", "-5", "word-", "-", "cont", ",c", "  lead", "trail  ",
    "—dash", "😀", "é", "ª", "Word one", "lower words that go on for a while", "pàge 7", "ſayfa 3", "pagİna 4", "pagına 5", "ſeite 6", "page", "3 of 4", "/", "\x1e", "sand", "第", "頁", " 8", "\tx", "a\xa0b",
]
BREAKS = ["\n", "\n", "\n", "\n", "\r\n", "\x0c", "\x1d", "\x85", " ", "\r", "\n\n\n"]


def random_texts(n, seed):
    rng = random.Random(seed)
    out = ["", "\n", "\r\n", "a\n", "a\n\n"]
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(0, 12)):
            parts += [rng.choice(PIECES), rng.choice(BREAKS)]
        if parts and rng.random() < 0.5:
            parts.pop()
        out.append("".join(parts))
    return out


def check(spark, rule, expected, seed, texts=None):
    texts = texts or random_texts(1500, seed)
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", rule(F.col("t")).alias("got")).collect()
    bad = [(r["t"], r["got"], expected(r["t"])) for r in rows if r["got"] != expected(r["t"])]
    assert not bad, bad[:3]


def test_lines(spark):
    check(spark, X.lines, str.splitlines, 1)


def test_strip(spark):
    check(spark, X.py_strip, str.strip, 3)


def test_squeeze(spark):
    check(spark, X.squeeze, lambda t: " ".join(t.split()), 4)


def test_lines_of_lambdas(spark):
    from folioworks.functions.repeats import long_lines

    def expected(t):
        return [" ".join(l.split()) for l in t.splitlines() if len(l.strip()) >= 3]

    check(spark, lambda c: long_lines(X.lines(c), 3), expected, 5)


def cases(spark, rule, pairs):
    """Given texts and what becomes of them, written by hand."""
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(pairs)], "i int, t string").select("i", rule(F.col("t")).alias("got")).collect()
    got = {r["i"]: r["got"] for r in rows}
    bad = [(t, got[i], want) for i, (t, want) in enumerate(pairs) if got[i] != want]
    assert not bad, bad[:3]


def test_weld(spark):
    cases(spark, X.weld, [
        ("", ""), ("one line", "one line"),
        ("a broken\nline goes on", "a broken line goes on"),
        ("three\nshort\nlines", "three short lines"),
        ("exam-\nple", "example"), ("exam-\nPle", "exam-\nPle"), ("twice-\nbro-\nken", "twicebroken"),
        ("It ends.\nnot joined", "It ends.\nnot joined"), ("Does it?\nno", "Does it?\nno"), ("so: \nlist", "so: \nlist"),
        ("(note)\nmore", "(note)\nmore"), ("first\nSecond", "first\nSecond"), ("item\n7 pieces", "item\n7 pieces"),
        ("left\n, right", "left , right"), ("left\n; right", "left ; right"), ("left\n— right", "left — right"), ("left\n– right", "left – right"),
        ("tail  \nhead", "tail head"), ("tail\n  head", "tail\n  head"),
        ("x" * 119 + "\ny", "x" * 119 + " y"), ("x" * 120 + "\ny", "x" * 120 + "\ny"), ("x" * 120 + "-\ny", "x" * 120 + "y"),
        ("x" * 118 + "\ny\nz", "x" * 118 + " y\nz"),
        ("éa-\nüb", "éaüb"), ("a\r\nb", "a b"),
    ])


def test_weld_only_moves_breaks_blanks_and_hyphens(spark):
    texts = random_texts(800, 7)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", X.weld(F.col("t")).alias("once")).collect()
    bare = lambda t: "".join(c for c in t if not c.isspace() and c not in "-\x1c\x1d\x1e\x85")
    for r in rows:
        assert bare(r["once"]) == bare(r["t"])
        assert len(r["once"].splitlines()) <= max(1, len(r["t"].splitlines()))


def test_marks(spark):
    cases(spark, X.normalize_marks, [
        ("", ""), ("• one", "- one"), ("  •two", "- two"), ("- kept", "- kept"), ("-joined", "- joined"), ("no • mark", "no • mark"),
        ("[x] done", "- [x] done"), ("  [X]  done", "- [x] done"), ("[ ] open", "- [ ] open"), ("[] open", "- [ ] open"), ("[y] other", "[y] other"),
        ("• a\n• b\ntext", "- a\n- b\ntext"),
    ])


def test_labels(spark):
    cases(spark, X.remove_page_labels, [
        ("", ""), ("Page 3", ""), ("page 3 of 9", ""), ("3 / 4", ""), ("12", ""), ("第 5 頁", ""), ("Seite 2", ""),
        ("text\nPage 3\nmore", "text\n\nmore"), ("on page 3 we see", "on page 3 we see"), ("12 apples", "12 apples"),
        ("a\n\n\n\nb", "a\n\nb"), ("a\n\nb", "a\n\nb"),
    ])


def test_labels_never_come_back(spark):
    texts = random_texts(800, 13)
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.remove_page_labels(F.col("t")).alias("once"))
    for r in df.select("t", "once", X.remove_page_labels(F.col("once")).alias("twice")).collect():
        assert "\n\n\n" not in r["once"] and len(r["once"]) <= len(r["t"])


def test_bare_numbers_may_stay(spark):
    cases(spark, lambda c: X.remove_page_labels(c, False), [("12", "12"), ("Page 3", ""), ("a\n7\nb", "a\n7\nb")])


def test_tokens(spark):
    cases(spark, X.token_count, [
        ("", 0), ("   \n", 0), ("one", 1), ("one two", 2), ("don't", 3), ("a_b 12", 2), ("...", 3), ("é", 1), ("naïve", 3), ("$10.00", 4), ("a\tb\nc", 3),
    ])


def test_tokens_add_up(spark):
    texts = random_texts(400, 19)
    pairs = list(zip(texts, reversed(texts)))
    df = spark.createDataFrame(pairs, "a string, b string")
    both = X.token_count(F.concat("a", F.lit(" "), "b"))
    rows = df.select(X.token_count(F.col("a")).alias("x"), X.token_count(F.col("b")).alias("y"), both.alias("z")).collect()
    assert all(r["x"] + r["y"] == r["z"] for r in rows)


def test_ngrams(spark):
    check(spark, X.ngrams, lambda t: [t[i : i + 3] for i in range(len(t) - 2)], 23)


def test_capital_words(spark):
    rng = random.Random(29)
    letters = list("AbCdÉé1$.-ªǅßΣ中")
    words = ["".join(rng.choices(letters, k=rng.randrange(1, 6))) for _ in range(2000)]
    check(spark, X.is_capital_word, lambda w: w.istitle() or w.isupper(), 0, words)
