"""Options of an ingest run."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EngineConfig:
    """Options; their values enter the plans as literals.

    ``block_pages`` is the number of pages of one document that may share a
    task: longer documents are split into blocks of that many pages. ``save_pages`` and
    ``keep_records`` say what ``sources.sinks.export`` writes besides texts and metadata.
    """

    min_text_page_ratio: float = 0.55
    max_pages_probe: int = 12
    ocr_engine: str = "auto"
    ocr_available: bool = True
    prompt_mode: str = "markdown"
    language: str = "auto"
    tables: str = "auto"
    edge_top: int = 2
    edge_bottom: int = 2
    edge_share: float = 0.45
    boiler_min_len: int = 6
    boiler_share: float = 0.5
    min_pages: int = 3
    max_join_len: int = 120
    bare_numbers: bool = True
    page_sep: str = ""
    save_pages: bool = False
    keep_records: bool = False
    block_pages: int = 256

    def __post_init__(self):
        for name, allowed in (
            ("ocr_engine", ("auto", "tesseract", "deepseek", "off")),
            ("prompt_mode", ("markdown", "plain")),
            ("language", ("auto", "off")),
            ("tables", ("auto", "docling", "camelot", "off")),
        ):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {', '.join(allowed)}")
        if self.block_pages < 1:
            raise ValueError("block_pages must be positive")
