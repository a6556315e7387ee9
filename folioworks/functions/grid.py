"""Rules on one extracted table, as Column -> Column functions.

A table is a value: ``struct<header array<string>, rows array<array<string>>>``
with rows as wide as the header and null for missing cells. It comes out of one
page text, so all rules run inside the row that holds it: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioworks import fixed_values as fixed
from folioworks.functions.text import WS, is_capital_word, let, py_strip, words

GRID_TYPE = "struct<header:array<string>,rows:array<array<string>>>"


def grid(header: Column, rows: Column) -> Column:
    return F.struct(header.alias("header"), rows.alias("rows"))


def _positions(width: Column) -> Column:
    return F.when(width > 0, F.sequence(F.lit(0), width - 1)).otherwise(F.array().cast("array<int>"))


def null_if_missing(cell: Column) -> Column:
    return F.when(~cell.isin(fixed.NA_WORDS), cell)


def rectangular(header: Column, rows: Column) -> Column:
    """Pad names with '' and rows with nulls to one common width."""

    def padded(both: Column) -> Column:
        h, r = both["header"], both["rows"]
        width = F.greatest(F.size(h), F.coalesce(F.array_max(F.transform(r, F.size)), F.lit(0)))
        return let(
            _positions(width),
            lambda at: grid(
                F.transform(at, lambda i: F.coalesce(F.get(h, i), F.lit(""))),
                F.transform(r, lambda row: F.transform(at, lambda i: F.get(row, i))),
            ),
        )

    return let(grid(header, rows), padded)


def strip_cells(g: Column) -> Column:
    return let(g, lambda t: grid(t["header"], F.transform(t["rows"], lambda r: F.transform(r, py_strip))))


def drop_empty(g: Column) -> Column:
    """Drop rows, then columns, that hold nothing but nulls."""

    def without_rows(t: Column) -> Column:
        kept = F.filter(t["rows"], lambda r: F.exists(r, lambda v: v.isNotNull()))
        return grid(t["header"], kept)

    def without_columns(t: Column) -> Column:
        filled = F.filter(
            _positions(F.size(t["header"])),
            lambda c: F.exists(t["rows"], lambda r: F.get(r, c).isNotNull()),
        )
        return let(
            filled,
            lambda cols: grid(
                F.transform(cols, lambda c: F.get(t["header"], c)),
                F.transform(t["rows"], lambda r: F.transform(cols, lambda c: F.get(r, c))),
            ),
        )

    return let(let(g, without_rows), without_columns)


def has_shape(g: Column, min_rows: int = 2, min_cols: int = 2) -> Column:
    return let(g, lambda t: (F.size(t["rows"]) >= min_rows) & (F.size(t["header"]) >= min_cols))


def min_shape(g: Column, min_rows: int = 2, min_cols: int = 2) -> Column:
    """The table, or null where it is too small."""
    return let(g, lambda t: F.when(has_shape(t, min_rows, min_cols), t))


def looks_like_header(row: Column) -> Column:
    """At least a third of the words of the row, and one, are capitalised."""
    return let(
        words(F.array_join(row, " ")),
        lambda ws: F.size(F.filter(ws, is_capital_word))
        >= F.greatest(F.lit(1), F.floor(F.size(ws) / 3).cast("int")),
    )


def promote_header(g: Column) -> Column:
    """Make the first row the header where it looks like one."""

    def promoted(t: Column) -> Column:
        first = F.get(t["rows"], F.lit(0))
        names = F.transform(first, lambda v: F.coalesce(v, F.lit("")))
        rest = F.filter(t["rows"], lambda _, i: i > 0)
        return F.when(looks_like_header(first), grid(names, rest)).otherwise(t)

    return let(g, promoted)


def squeeze_header(g: Column) -> Column:
    def names(t: Column) -> Column:
        return F.transform(t["header"], lambda v: py_strip(F.regexp_replace(v, WS + "+", " ")))

    return let(g, lambda t: grid(names(t), t["rows"]))


def numeric_columns(g: Column) -> Column:
    """One boolean per column: more than 80 % of its filled cells are numbers."""

    def numeric(values: Column) -> Column:
        hits = F.size(F.filter(values, lambda v: v.rlike(r"\A[\p{Nd}.,%\-]+\z")))
        return (F.size(values) > 0) & (hits / F.greatest(F.size(values), F.lit(1)) > fixed.NUMERIC_SHARE)

    def flags(t: Column) -> Column:
        return F.transform(
            _positions(F.size(t["header"])),
            lambda c: let(
                F.filter(F.transform(t["rows"], lambda r: F.get(r, c)), lambda v: v.isNotNull()), numeric
            ),
        )

    return let(g, flags)


def comma_to_dot(g: Column) -> Column:
    """Decimal comma to dot in numeric columns; nulls stay null."""

    def dotted(t: Column) -> Column:
        def cell(flags: Column):
            return lambda v, i: F.when(F.get(flags, i), F.replace(v, F.lit(","), F.lit("."))).otherwise(v)

        return let(
            numeric_columns(t),
            lambda flags: grid(t["header"], F.transform(t["rows"], lambda r: F.transform(r, cell(flags)))),
        )

    return let(g, dotted)


def clean(g: Column, min_rows: int = 2, min_cols: int = 2) -> Column:
    """The whole chain; null where no table of the wanted shape is left."""
    shaped = min_shape(drop_empty(strip_cells(g)), min_rows, min_cols)
    named = squeeze_header(promote_header(shaped))
    return min_shape(drop_empty(comma_to_dot(named)), min_rows, min_cols)


def _score(rows: Column, cols: Column, empty: Column) -> Column:
    cells = (rows * cols).cast("double")
    return F.when(cells > 0, cells / (1 + 10 * (empty / F.greatest(cells, F.lit(1.0))))).otherwise(0.0)


def _count_cells(t: Column, test) -> Column:
    return F.aggregate(t["rows"], F.lit(0), lambda n, r: n + F.size(F.filter(r, test)))


def table_score(g: Column) -> Column:
    """Size over emptiness, a fifth more where every column has a name."""

    def score(t: Column) -> Column:
        empty = _count_cells(t, lambda v: v.isNull())
        named = F.forall(t["header"], lambda v: v.isNotNull() & (v != ""))
        base = _score(F.size(t["rows"]), F.size(t["header"]), empty)
        return base * F.when(named, 1.2).otherwise(1.0)

    return F.coalesce(let(g, score), F.lit(0.0))


def csv_score(g: Column) -> Column:
    """The score of the table as read back from its CSV: NA words are empty."""

    def score(t: Column) -> Column:
        empty = _count_cells(t, lambda v: v.isNull() | v.isin(fixed.NA_WORDS))
        return _score(F.size(t["rows"]), F.size(t["header"]), empty)

    return F.coalesce(let(g, score), F.lit(0.0))


def render_csv(g: Column) -> Column:
    def field(v: Column) -> Column:
        quoted = F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(v.rlike('[",\r\n]'), quoted).otherwise(F.coalesce(v, F.lit("")))

    def line(r: Column) -> Column:
        return F.concat(F.array_join(F.transform(r, field), ","), F.lit("\n"))

    return let(
        g, lambda t: F.concat(line(t["header"]), F.array_join(F.transform(t["rows"], line), ""))
    )


def render_html(g: Column) -> Column:
    def escaped(v: Column) -> Column:
        text = F.coalesce(v, F.lit(""))
        for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(sign), F.lit(entity))
        return text

    def line(r: Column, tag: str) -> Column:
        cells = F.transform(r, lambda v: F.concat(F.lit(f"<{tag}>"), escaped(v), F.lit(f"</{tag}>")))
        return F.concat(F.lit("<tr>"), F.array_join(cells, ""), F.lit("</tr>"))

    return let(
        g,
        lambda t: F.concat(
            F.lit("<table><tbody>"),
            line(t["header"], "th"),
            F.array_join(F.transform(t["rows"], lambda r: line(r, "td")), ""),
            F.lit("</tbody></table>"),
        ),
    )


def render_md(g: Column) -> Column:
    def line(r: Column) -> Column:
        cells = F.transform(r, lambda v: F.replace(F.coalesce(v, F.lit("")), F.lit("|"), F.lit("\\|")))
        return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))

    return let(
        g,
        lambda t: F.array_join(
            F.concat(
                F.array(line(t["header"]), F.concat(F.repeat(F.lit("|---"), F.size(t["header"])), F.lit("|"))),
                F.transform(t["rows"], line),
            ),
            "\n",
        ),
    )
