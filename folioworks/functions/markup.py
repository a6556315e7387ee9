"""Tables inside markdown and HTML texts, as Column -> Column functions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioworks import fixed_values as fixed
from folioworks.functions.grid import grid, null_if_missing, rectangular
from folioworks.functions.text import WS, let, py_strip, unify_breaks

_BLANK = r"[\p{IsWhite_Space}\x1c-\x1f&&[^\n]]"
# A line opening with a pipe, a delimiter line, then all lines opening with a
# pipe. Possessive repeats keep the matcher from recursing once per line.
_PIPE_LINE = rf"{_BLANK}*+\|[^\n]*+"
_DELIMITER = rf"{_BLANK}*[|:\-](?:[|:\- ]*[|:\-])?{_BLANK}*"
PIPE_TABLE = rf"(?md)^{_PIPE_LINE}\n{_DELIMITER}(?=\n|\z)(?:\n{_PIPE_LINE})*+"


def pipe_tables(text: Column) -> Column:
    """The pipe tables of a markdown text, in order, as written."""
    return F.regexp_extract_all(unify_breaks(text), F.lit(PIPE_TABLE), F.lit(0))


def pipe_cells(line: Column) -> Column:
    inner = F.regexp_replace(py_strip(line), r"\A\||(?<!\\)\|\z", "")
    return F.transform(
        F.split(inner, r"(?<!\\)\|", -1),
        lambda v: py_strip(F.replace(v, F.lit("\\|"), F.lit("|"))),
    )


def pipe_grid(md: Column) -> Column:
    """Header and body of one pipe table; empty cells are null."""

    def parsed(ls: Column) -> Column:
        body = F.filter(ls, lambda _, i: i >= 2)
        return rectangular(
            pipe_cells(F.get(ls, F.lit(0))),
            F.transform(body, lambda l: F.transform(pipe_cells(l), null_if_missing)),
        )

    return let(F.split(md, "\n", -1), parsed)


def _by_depth(visible: Column) -> Column:
    """All <table> elements in the order of their start tags, nested ones too.

    A fold over the pieces between the tags with a stack of the open tables. When a table
    closes, its text without markup joins that of the table around it, so the cell that held
    it keeps its words and each table is free of others. What is open at the end closes there.
    """
    closed = F.regexp_replace(visible, r"(?i)</table\s*>", "</table>")
    pieces = F.split(closed, r"(?i)(?=<table\b)|(?<=</table>)", -1)
    table = "struct<no:int,html:string>"
    start = F.struct(
        F.array().cast(f"array<{table}>").alias("open"), F.array().cast(f"array<{table}>").alias("done"), F.lit(0).alias("next")
    )

    def entry(no: Column, html: Column) -> Column:
        return F.struct(no.alias("no"), html.alias("html"))

    def added(stack: Column, text: Column) -> Column:
        """The stack with ``text`` at the end of its top table; nothing if it is empty."""
        top = F.get(stack, F.size(stack) - 1)
        more = F.concat(F.slice(stack, 1, F.size(stack) - 1), F.array(entry(top["no"], F.concat(top["html"], text))))
        return F.when(F.size(stack) > 0, more).otherwise(stack)

    def words(html: Column) -> Column:
        return F.regexp_replace(html, r"(?i)<(?!br\b)[^>]*>", "")

    def popped(state: Column) -> Column:
        stack = state["open"]
        top = F.get(stack, F.size(stack) - 1)
        below = F.slice(stack, 1, F.size(stack) - 1)
        return F.when(
            F.size(stack) > 0,
            F.struct(
                added(below, words(top["html"])).alias("open"),
                F.concat(state["done"], F.array(entry(top["no"], F.concat(top["html"], F.lit("</table>"))))).alias("done"),
                state["next"].alias("next"),
            ),
        ).otherwise(state)

    def step(state: Column, piece: Column) -> Column:
        opens, closes = piece.rlike(r"(?i)\A<table\b"), F.endswith(piece, F.lit("</table>"))
        body = F.when(closes, F.substr(piece, F.lit(1), F.length(piece) - len("</table>"))).otherwise(piece)
        begun = F.when(
            opens,
            F.struct(
                F.concat(state["open"], F.array(entry(state["next"], body))).alias("open"), state["done"].alias("done"), (state["next"] + 1).alias("next")
            ),
        ).otherwise(F.struct(added(state["open"], body).alias("open"), state["done"].alias("done"), state["next"].alias("next")))
        return let(begun, lambda s: F.when(closes, popped(s)).otherwise(s))

    def finish(state: Column) -> Column:
        ended = F.aggregate(F.sequence(F.lit(0), F.size(state["open"])), state, lambda s, _: popped(s))
        return F.transform(F.sort_array(ended["done"]), lambda t: t["html"])

    return F.aggregate(pieces, start, step, finish)


def html_tables(html: Column) -> Column:
    """The <table> elements of a page in order; a nested one follows the one around it, which keeps its text."""
    visible = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "")
    found = F.regexp_extract_all(visible, F.lit(r"(?is)<table\b.*?(?:</table\s*>|\z)"), F.lit(0))
    return let(
        F.struct(visible.alias("visible"), found.alias("found")),
        lambda x: F.when(
            F.exists(x["found"], lambda t: F.regexp_count(t, F.lit(r"(?i)<table\b")) > 1), _by_depth(x["visible"])
        ).otherwise(x["found"]),
    )


def _named_references() -> Column:
    """All named references of HTML that end with a semicolon, as one literal map; &amp; is left out."""
    names = {f"&{name}": char for name, char in html5.items() if name.endswith(";") and name.lower() != "amp;"}
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _decoded(text: Column) -> Column:
    """Character references as characters: decimal, hexadecimal and named ones, &amp; last."""
    refs = F.array_distinct(F.regexp_extract_all(text, F.lit(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);"), F.lit(0)))

    def put(acc: Column, ref: Column) -> Column:
        decimal = F.regexp_extract(ref, "^&#0*([0-9]{1,7});$", 1)
        hexadecimal = F.regexp_extract(ref, "^&#[xX]0*([0-9a-fA-F]{1,6});$", 1)
        number = F.coalesce(F.nullif(decimal, F.lit("")).cast("int"), F.conv(F.nullif(hexadecimal, F.lit("")), 16, 10).cast("int"))
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        coded = F.when(number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF), char)
        named = F.when(~F.startswith(ref, F.lit("&#")), F.element_at(_named_references(), ref))
        return F.replace(acc, ref, F.coalesce(coded, named, ref))

    out = F.when(F.contains(text, F.lit("&")), F.aggregate(refs, text, put)).otherwise(text)
    return F.replace(F.replace(out, F.lit("&amp;"), F.lit("&")), F.lit("&AMP;"), F.lit("&"))


def _span(tag: Column, name: str, most: int) -> Column:
    """A span attribute; as in HTML, a number over ``most`` counts as that."""
    found = F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*[\"']?0*([0-9]+)", 1)
    number = F.when(F.length(found) > 8, most).otherwise(F.nullif(found, F.lit("")).cast("int"))
    return F.greatest(F.lit(1), F.least(F.coalesce(number, F.lit(1)), F.lit(most)))


def _cell(element: Column) -> Column:
    tag = F.regexp_extract(element, r"\A<[^>]*>", 0)
    inner = F.regexp_replace(element, r"\A<[^>]*>", "")
    text = F.regexp_replace(F.regexp_replace(inner, r"(?i)<br\b[^>]*>", "\n"), r"<[^>]*>", "")
    return F.struct(
        F.regexp_replace(py_strip(_decoded(text)), rf"[\r\n]+|{WS}{{2,}}", " ").alias("text"),
        element.rlike(r"(?i)\A<th\b").alias("is_th"),
        _span(tag, "colspan", fixed.MOST_COLSPAN).alias("across"),
        _span(tag, "rowspan", fixed.MOST_ROWSPAN).alias("down"),
    )


def _rows(html: Column) -> Column:
    """Rows of cells, each cell with its text, kind and spans."""
    rows = F.regexp_extract_all(
        html, F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|</tr|</t(?:able|head|body|foot)|\z)"), F.lit(1)
    )
    return F.transform(
        rows,
        lambda r: F.transform(
            F.regexp_extract_all(
                r, F.lit(r"(?is)<t[dh]\b[^>]*>.*?(?=<t[dh]\b|</t[dhr]\b|\z)"), F.lit(0)
            ),
            _cell,
        ),
    )


def _spread(rows: Column) -> Column:
    """Cell texts with colspans and rowspans written out."""
    across = F.transform(rows, lambda r: F.flatten(F.transform(r, lambda c: F.array_repeat(c, c["across"]))))
    plain = F.transform(across, lambda r: F.transform(r, lambda c: c["text"]))

    def place(acc: Column, units: Column) -> Column:
        held = acc["held"]
        taken = F.transform(held, lambda h: h["col"])
        last = F.coalesce(F.array_max(taken), F.lit(0)) + F.size(units)
        free = F.filter(F.sequence(F.lit(0), last), lambda p: ~F.array_contains(taken, p))

        def landed(at: Column) -> Column:
            placed = F.transform(
                units,
                lambda u, j: F.struct(F.get(at, j).alias("col"), u["text"].alias("text"), u["down"].alias("down")),
            )
            return F.sort_array(F.concat(placed, held))

        return let(
            let(free, landed),
            lambda line: F.struct(
                F.concat(acc["done"], F.array(F.transform(line, lambda x: x["text"]))).alias("done"),
                F.filter(
                    F.transform(
                        line,
                        lambda x: F.struct(x["col"].alias("col"), x["text"].alias("text"), (x["down"] - 1).alias("down")),
                    ),
                    lambda x: x["down"] > 0,
                ).alias("held"),
            ),
        )

    def finish(acc: Column) -> Column:
        left = F.coalesce(F.array_max(F.transform(acc["held"], lambda h: h["down"])), F.lit(0))
        extra = F.when(
            left > 0,
            F.transform(
                F.sequence(F.lit(1), left),
                lambda k: F.transform(F.filter(acc["held"], lambda h: h["down"] >= k), lambda h: h["text"]),
            ),
        ).otherwise(F.array().cast("array<array<string>>"))
        return F.concat(acc["done"], extra)

    start = F.struct(
        F.array().cast("array<array<string>>").alias("done"),
        F.array().cast("array<struct<col:int,text:string,down:int>>").alias("held"),
    )
    spans = F.exists(rows, lambda r: F.exists(r, lambda c: c["down"] > 1))
    return F.when(spans, F.aggregate(across, start, place, finish)).otherwise(plain)


def html_grid(html: Column) -> Column:
    """One <table> element as a table; rows of <th> at its top are the header."""

    def parsed(rows: Column) -> Column:
        in_head = F.regexp_count(
            F.regexp_extract(html, r"(?is)<thead\b.*?</thead", 0), F.lit(r"(?i)<tr\b")
        )
        all_th = F.transform(rows, lambda r: F.forall(r, lambda c: c["is_th"]))
        first_body = F.array_position(all_th, F.lit(False))
        leading = F.when(first_body > 0, first_body - 1).otherwise(F.size(rows))
        n_head = F.when(in_head > 0, in_head).otherwise(leading).cast("int")
        return let(
            F.struct(_spread(rows).alias("lines"), n_head.alias("n")),
            lambda t: with_names(
                F.filter(t["lines"], lambda _, i: i < t["n"]), F.filter(t["lines"], lambda _, i: i >= t["n"])
            ),
        )

    def with_names(head: Column, body: Column) -> Column:
        width = F.coalesce(F.array_max(F.transform(F.concat(head, body), F.size)), F.lit(0))
        at = F.when(width > 0, F.sequence(F.lit(0), width - 1)).otherwise(F.array().cast("array<int>"))

        def name(i: Column) -> Column:
            levels = F.transform(
                head,
                lambda h: F.coalesce(
                    F.nullif(F.get(h, i), F.lit("")), F.concat(F.lit("Unnamed: "), i.cast("string"))
                ),
            )
            return (
                F.when(F.size(head) == 0, i.cast("string"))
                .when(F.size(head) == 1, F.get(levels, F.lit(0)))
                .otherwise(F.concat(F.lit("('"), F.array_join(levels, "', '"), F.lit("')")))
            )

        return rectangular(
            F.transform(at, name), F.transform(body, lambda r: F.transform(r, null_if_missing))
        )

    return let(_rows(html), parsed)
