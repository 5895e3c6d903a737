"""Registered queries of the package and their DuckDB SQL (where SQL can express one)."""

from __future__ import annotations

from postflow.llm.byte_bpe import op8_byte_bpe
from postflow.llm.conv_trie import OP13_SQL, op13_conversation_trie
from postflow.llm.decontaminate import OP10_SQL, op10_decontaminate
from postflow.llm.fingerprint import op11_fingerprint
from postflow.llm.html_text import op7_html_text
from postflow.llm.license_scan import op2_license_scan
from postflow.llm.near_dedup import op9_near_dedup
from postflow.llm.prefix_forest import op1_prefix_forest
from postflow.llm.quality_model import op4_quality
from postflow.llm.spelling import OP12_SQL, op12_spelling
from postflow.llm.suffix_dedup import op5_suffix_dedup
from postflow.llm.token_files import op6_token_files
from postflow.llm.warc import OP3_SQL, op3_warc

QUERIES = {
    "op1_prefix_forest": op1_prefix_forest,
    "op2_license_scan": op2_license_scan,
    "op3_warc": op3_warc,
    "op4_quality": op4_quality,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_token_files": op6_token_files,
    "op7_html_text": op7_html_text,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_near_dedup": op9_near_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_fingerprint": op11_fingerprint,
    "op12_spelling": op12_spelling,
    "op13_conversation_trie": op13_conversation_trie,
}

#: The others (nearest neighbours, learned scores, byte spans, ids of tokenizers, components over
#: shingle sets, fuzzy spans, main text, fingerprints) are compared with brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op3_warc": OP3_SQL,
    "op10_decontaminate": OP10_SQL,
    "op12_spelling": OP12_SQL,
    "op13_conversation_trie": OP13_SQL,
}
