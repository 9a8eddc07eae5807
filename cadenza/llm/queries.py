"""Registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from cadenza.llm.decontaminate import op2_benchmark_decontamination
from cadenza.llm.divergence import op11_source_divergence
from cadenza.llm.html_wrapper import op8_html_main_text
from cadenza.llm.licenses import op9_license_scan
from cadenza.llm.mixing import op1_mix_sources
from cadenza.llm.near_dedup import op5_minhash_near_dedup
from cadenza.llm.oracle import ORACLE
from cadenza.llm.piece_spans import op13_sentencepiece_spans
from cadenza.llm.span_dedup import op6_substring_dedup
from cadenza.llm.spotsigs import op10_spotsigs
from cadenza.llm.suffix_dedup import op4_suffix_array_dedup
from cadenza.llm.token_files import op3_token_files
from cadenza.llm.token_alignment import op12_tokenizer_alignment
from cadenza.llm.toxicity import op7_toxicity

QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_benchmark_decontamination, op3_token_files, op4_suffix_array_dedup, op5_minhash_near_dedup,
    op6_substring_dedup, op7_toxicity, op8_html_main_text, op9_license_scan, op10_spotsigs, op11_source_divergence, op12_tokenizer_alignment,
    op13_sentencepiece_spans)}

__all__ = ["ORACLE", "QUERIES"]
