"""Lines that repeat within a document, found inside the row that holds it.

A document (or a block of one) is an array of pages, a page an array of lines.
Sorting all candidate lines puts equal ones side by side, so a line occurs at
least m times exactly if it equals the line m - 1 places further on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioworks.functions.text import empty_strings, let, lines, squeeze_line, strip_line


def enough(n: Column, share: float) -> Column:
    """The smallest count c with c / n >= share, by that very division."""
    near = F.greatest(F.lit(1), F.ceil(n * share).cast("int") - 1)
    return F.when(near / n >= share, near).when((near + 1) / n >= share, near + 1).otherwise(near + 2)


def frequent(items: Column, n: Column, share: float) -> Column:
    """Distinct items that occur in ``items`` at least share * n times."""
    return let(
        F.struct(F.sort_array(items).alias("s"), (enough(n, share) - 1).alias("gap")),
        lambda x: F.array_distinct(F.filter(x["s"], lambda item, i: item == F.get(x["s"], i + x["gap"]))),
    )


def top_lines(stripped: Column, k: int) -> Column:
    """The filled ones among the first k lines."""
    return F.filter(F.slice(stripped, 1, k), lambda l: l != "")


def bottom_lines(stripped: Column, k: int) -> Column:
    """The last k filled lines."""
    return let(
        F.filter(stripped, lambda l: l != ""),
        lambda filled: F.slice(filled, F.greatest(F.size(filled) - k + 1, F.lit(1)), k),
    )


def stripped_lines(text: Column) -> Column:
    return F.transform(lines(text), strip_line)


def repeated_edges(pages: Column, n: Column, top_k: int, bottom_k: int, share: float) -> Column:
    """Lines that open, or that close, a share of the pages (array of line arrays)."""

    def found(stripped: Column) -> Column:
        tops = F.flatten(F.transform(stripped, lambda ls: top_lines(ls, top_k)))
        bottoms = F.flatten(F.transform(stripped, lambda ls: bottom_lines(ls, bottom_k)))
        return F.array_union(frequent(tops, n, share), frequent(bottoms, n, share))

    return let(F.transform(pages, lambda ls: F.transform(ls, strip_line)), found)


def without_edges(ls: Column, edges: Column) -> Column:
    """Lines that are neither blank nor one of the edge lines."""
    return F.filter(
        ls, lambda l: let(strip_line(l), lambda s: (s != "") & ~F.array_contains(edges, s))
    )


def long_lines(ls: Column, min_len: int) -> Column:
    """Lines of enough characters, with their whitespace normalised."""
    return F.transform(F.filter(ls, lambda l: F.length(strip_line(l)) >= min_len), squeeze_line)


def repeated_lines(pages: Column, n: Column, share: float) -> Column:
    """Lines found on a share of the pages, each counted once per page."""
    return frequent(F.flatten(F.transform(pages, F.array_distinct)), n, share)


def digest(line: Column) -> Column:
    """What stands for a line where many are counted: a short line itself, of a longer one its SHA-256, which is longer than the former."""
    return F.when(F.octet_length(line) < 32, line.cast("binary")).otherwise(F.unhex(F.sha2(line, 256)))


def known(ls: Column, digests: Column) -> Column:
    """Distinct ones of the lines that ``digests`` stand for."""
    found = F.filter(F.array_distinct(ls), lambda l: F.array_contains(digests, digest(l)))
    return F.when(F.size(digests) > 0, found).otherwise(empty_strings())


def without(ls: Column, dropped: Column) -> Column:
    return F.filter(ls, lambda l: ~F.array_contains(dropped, l))
