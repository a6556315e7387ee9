"""Text rules as Column -> Column functions; all of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioworks import fixed_values as fixed

WS = r"[\p{IsWhite_Space}\x1c-\x1f]"
_CONTINUES = r"[\p{IsLowercase}" + fixed.CONTINUATION_SIGNS + "]"
_MARK = "\x1e"
_SENTENCE_END = "[" + fixed.SENTENCE_END + r"]\z"


def _java(pattern: str) -> str:
    """Spell \\s and \\d out the way Python reads them."""
    return pattern.replace(r"\s", WS).replace(r"\d", r"\p{Nd}")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    A plain column that a lambda uses may be inlined by the optimizer and
    evaluated again for every array element; a lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def py_strip(c: Column) -> Column:
    return F.btrim(c, F.lit(fixed.WHITESPACE))


def py_rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(fixed.WHITESPACE))


def _has_any(c: Column, signs) -> Column:
    """Substring searches: far cheaper than a regex over the text."""
    return reduce(or_, [F.contains(c, F.lit(ch)) for ch in signs])


def strip_line(l: Column) -> Column:
    """py_strip for lambda variables: a line with visible ASCII at both ends
    is passed on after two comparisons."""
    last = F.right(l, F.lit(1))
    tight = l.between("!", "~") & last.between("!", "~")
    return F.when(tight, l).otherwise(py_strip(l))


def squeeze(c: Column) -> Column:
    """Whitespace runs become one space; ends are stripped."""
    # single spaces, which are most of the runs, are left where they are
    return F.regexp_replace(py_strip(c), rf"[\p{{IsWhite_Space}}\x1c-\x1f&&[^ ]]{WS}*+| {WS}++", " ")


def squeeze_line(l: Column) -> Column:
    """squeeze for lambda variables: the regex only sees lines that need it."""
    rare = F.contains(l, F.lit("  ")) | _has_any(l, [ch for ch in fixed.WHITESPACE if ch < "\x7f" and ch != " "])
    wide = (F.octet_length(l) != F.length(l)) & _has_any(l, [ch for ch in fixed.WHITESPACE if ch > "\x7f"])
    return F.when(rare | wide, squeeze(l)).otherwise(strip_line(l))


def unify_breaks(c: Column) -> Column:
    """All line breaks as one newline, without a break at the end.

    Most texts hold no break but newlines and are spared the replacement.
    """
    plain = F.when(_has_any(c, fixed.ODD_BREAKS), F.regexp_replace(c, fixed.LINE_BREAK, "\n")).otherwise(c)
    return let(plain, lambda t: F.when(t.endswith("\n"), F.left(t, F.length(t) - 1)).otherwise(t))


def lines(c: Column) -> Column:
    """Lines of a text; an empty text has none, a final break opens none."""
    return F.when(c == "", empty_strings()).otherwise(F.split(unify_breaks(c), "\n", -1))


def weld(c: Column, max_join_len: int = 120) -> Column:
    """Join lines that continue the line above into paragraphs.

    Whether a line *may* continue shows in its first character alone, so the
    text is first split into runs of such lines by one regex. Only runs of
    more than one line need the fold that watches the length reached so far.
    """

    def step(acc: Column, line: Column) -> Column:
        done, cur = acc["done"], acc["cur"]
        hyphen = cur.endswith("-") & line.rlike(r"\A\p{IsLowercase}")
        joins = (F.length(cur) < max_join_len) & ~py_strip(cur).rlike(_SENTENCE_END)

        def state(d: Column, text: Column) -> Column:
            return F.struct(d.alias("done"), text.alias("cur"))

        return (
            F.when(cur.isNull(), state(done, line))
            .when(hyphen, state(done, F.concat(F.left(cur, F.length(cur) - 1), line)))
            .when(joins, state(done, F.concat(py_rstrip(cur), F.lit(" "), line)))
            .otherwise(state(F.concat(done, cur, F.lit("\n")), line))
        )

    def fold(run: Column) -> Column:
        start = F.struct(F.lit("").alias("done"), F.lit(None).cast("string").alias("cur"))
        return F.aggregate(
            F.split(run, "\n", -1), start, step, lambda acc: F.concat(acc["done"], acc["cur"])
        )

    # unified text has no record separators, so they can mark where runs end
    marked = F.regexp_replace(unify_breaks(c), rf"\n(?!{_CONTINUES})", _MARK)
    runs = F.split(marked, _MARK, -1)
    return F.array_join(
        F.transform(runs, lambda run: F.when(F.contains(run, F.lit("\n")), fold(run)).otherwise(run)),
        "\n",
    )


def normalize_bullets(c: Column) -> Column:
    pattern = _java(rf"(?md)^[\t ]*[{fixed.BULLETS}\-]\s*(.*)$")
    return F.regexp_replace(c, pattern, r"- $1")


def normalize_checked(c: Column) -> Column:
    return F.regexp_replace(c, _java(r"(?md)^[\t ]*\[[xX]\]\s*"), "- [x] ")


def normalize_unchecked(c: Column) -> Column:
    return F.regexp_replace(c, _java(r"(?md)^[\t ]*\[\s*\]\s*"), "- [ ] ")


def normalize_marks(c: Column) -> Column:
    boxes = let(
        normalize_bullets(c),
        lambda t: F.when(F.contains(t, F.lit("[")), normalize_unchecked(normalize_checked(t))).otherwise(t),
    )
    return boxes


# Lines made of nothing but what labels are made of. A label covers whole
# lines, and only such lines, so it always lies within one run of them.
_LABEL_RUN = r"(?md)^[\s\d/第頁pageáàinsyftdoPAGEÁÀINSYFTDOſıİ]+$"


def _without_labels(c: Column, patterns: list[str]) -> Column:
    for pattern in patterns:
        c = F.regexp_replace(c, "(?imdu)" + _java(pattern), "")
    return c


def strip_page_labels(c: Column, bare_numbers: bool = True) -> Column:
    """Take page labels out. The last rule also takes lines of one bare number.

    One scan sets the runs of lines apart that labels can lie in; the labels'
    own expressions see these runs alone, not the whole page.
    """
    patterns = fixed.PAGE_LABELS if bare_numbers else fixed.PAGE_LABELS[:-1]

    def in_runs(t: Column) -> Column:
        pieces = F.split(F.regexp_replace(t, _java(_LABEL_RUN), f"{_MARK}$0{_MARK}"), _MARK, -1)
        return F.array_join(
            F.transform(pieces, lambda p, i: F.when(i % 2 == 1, _without_labels(p, patterns)).otherwise(p)), ""
        )

    return let(c, lambda t: F.when(F.contains(t, F.lit(_MARK)), _without_labels(t, patterns)).otherwise(in_runs(t)))


def collapse_blank(c: Column) -> Column:
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def remove_page_labels(c: Column, bare_numbers: bool = True) -> Column:
    return let(
        strip_page_labels(c, bare_numbers),
        lambda t: F.when(F.contains(t, F.lit("\n\n\n")), collapse_blank(t)).otherwise(t),
    )


def token_count(c: Column) -> Column:
    """ASCII word runs, and every other visible character, count one each."""
    return F.regexp_count(c, F.lit(r"[A-Za-z0-9_]+|[^A-Za-z0-9_\p{IsWhite_Space}\x1c-\x1f]"))


def ngrams(c: Column, n: int = 3) -> Column:
    """All overlapping n-grams of a text, in order, by whole code points."""
    return F.regexp_extract_all(c, F.lit(rf"(?s)(?=(.{{{n}}}))."), F.lit(1))


def _is_upper(word: Column) -> Column:
    return word.rlike(r"\p{IsUppercase}") & ~word.rlike(r"[\p{IsLowercase}\p{Lt}]")


def _is_title(word: Column) -> Column:
    cased = r"[\p{IsUppercase}\p{IsLowercase}\p{Lt}]"
    return (
        word.rlike(cased)
        & ~word.rlike(rf"(?<={cased})[\p{{IsUppercase}}\p{{Lt}}]")
        & ~word.rlike(rf"(?<!{cased})\p{{IsLowercase}}")
    )


def is_capital_word(word: Column) -> Column:
    """Title case or upper case, as Python's istitle / isupper say."""
    return _is_upper(word) | _is_title(word)


def words(c: Column) -> Column:
    return F.filter(F.split(c, WS + "+", -1), lambda w: w != "")
