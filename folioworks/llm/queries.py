"""The registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from folioworks.llm.byte_bpe import op7_byte_bpe
from folioworks.llm.decontaminate import op1_decontamination
from folioworks.llm.edit_fingerprint import op11_edit_fingerprint
from folioworks.llm.importance import OP13_SQL, op13_resample
from folioworks.llm.near_dedup import op9_near_dedup
from folioworks.llm.neighbours import op6_neighbours
from folioworks.llm.page_language import op8_page_language
from folioworks.llm.perspectives import OP10_SQL, op10_perspectives
from folioworks.llm.quality import op5_quality
from folioworks.llm.sharding import op4_sharding
from folioworks.llm.spelling import OP12_SQL, op12_spelling
from folioworks.llm.toxicity import op2_toxicity
from folioworks.llm.warc import OP3_SQL, op3_warc

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_warc": op3_warc,
    "op4_sharding": op4_sharding,
    "op5_quality": op5_quality,
    "op6_neighbours": op6_neighbours,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_page_language": op8_page_language,
    "op9_near_dedup": op9_near_dedup,
    "op10_perspectives": op10_perspectives,
    "op11_edit_fingerprint": op11_edit_fingerprint,
    "op12_spelling": op12_spelling,
    "op13_resample": op13_resample,
}

ORACLES: dict[str, str] = {"op3_warc": OP3_SQL, "op10_perspectives": OP10_SQL, "op12_spelling": OP12_SQL, "op13_resample": OP13_SQL}
