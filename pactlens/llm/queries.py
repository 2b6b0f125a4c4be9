"""Registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pactlens.llm.bpe import op9_encode_decode
from pactlens.llm.extract import op7_extract_text
from pactlens.llm.fingerprint import op1_fingerprints
from pactlens.llm.lines import OP3_SQL, op3_line_dedup
from pactlens.llm.lm import op10_lm_scores
from pactlens.llm.mixing import op2_mix_sources
from pactlens.llm.neardup import op4_near_duplicates
from pactlens.llm.permindex import op5_permutation_index
from pactlens.llm.quality import op6_quality
from pactlens.llm.runs import op11_periodic_runs
from pactlens.llm.substring import op8_substring_dedup
from pactlens.llm.suffixes import op13_suffix_dedup
from pactlens.llm.variants import op12_spelling_variants

QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_mix_sources": op2_mix_sources,
    "op3_line_dedup": op3_line_dedup,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_permutation_index": op5_permutation_index,
    "op6_quality": op6_quality,
    "op7_extract_text": op7_extract_text,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_encode_decode": op9_encode_decode,
    "op10_lm_scores": op10_lm_scores,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_suffix_dedup": op13_suffix_dedup,
}
ORACLE: dict[str, str] = {"op3_line_dedup": OP3_SQL}
