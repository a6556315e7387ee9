"""Patterns, word lists and constants that decide results.

Everything here must keep exactly these values; nothing here is logic.
"""

# Characters Python's str.isspace() accepts, used by strip and by \s.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Line breaks Python's str.splitlines() accepts, as a Java regex.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"

# The line breaks other than the newline.
ODD_BREAKS = ["\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029"]

# Page labels, applied in this order; case-insensitive, multi-line.
PAGE_LABELS = [
    r"^page\s+\d+(\s*/\s*\d+| of \d+)?$",
    r"^p[aá]gina\s+\d+(\s*de\s*\d+)?$",
    r"^sayfa\s+\d+(\s*/\s*\d+)?$",
    r"^seite\s+\d+(\s*/\s*\d+)?$",
    r"^p[aà]ge\s+\d+(\s*/\s*\d+)?$",
    r"^\d+\s*/\s*\d+$",
    r"^第?\s*\d+\s*頁?$",
]

# Signs that open a list item.
BULLETS = "•◦‣⁃▪▫●○♦▶►▸−–—"

# A line ending in one of these closes its paragraph.
SENTENCE_END = ".?!:;)"

# A line opening with one of these continues the line above.
CONTINUATION_SIGNS = ",;—–"

# A page with more characters than this counts as a text page.
TEXT_PAGE_CHARS = 40

# A column is numeric when more than this share of its cells is a number.
NUMERIC_SHARE = 0.8

# Cell texts that a CSV or HTML table reader takes as missing.
NA_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# The most columns and rows that a cell of an HTML table may span.
MOST_COLSPAN = 1000
MOST_ROWSPAN = 65534

# (engine flag, OCR available, router choice, use OCR, reason); None = any.
ROUTE_RULES = [
    ("off", None, None, False, "ocr_disabled_by_flag"),
    ("deepseek", False, None, False, "deepseek_missing"),
    ("deepseek", True, None, True, "forced_deepseek"),
    ("tesseract", False, None, False, "tesseract_unavailable"),
    ("tesseract", True, None, True, "tesseract_unavailable_used_deepseek"),
    ("auto", False, "ocr", False, "ocr_engine_missing"),
    ("auto", True, "ocr", True, "router_ocr"),
    ("auto", None, "non_ocr", False, "router_non_ocr"),
]

# Table engines in the order they are tried.
TABLE_ENGINES = ["docling", "markdown", "camelot"]
