"""Queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from millrace.llm.bpe import op9_bpe
from millrace.llm.jaccard import OP7_SQL, op7_ngram_jaccard
from millrace.llm.licences import op1_licences
from millrace.llm.lm import op10_pseudo_likelihood
from millrace.llm.media import op3_media
from millrace.llm.packing import op8_packing
from millrace.llm.quality import OP4_SQL, op4_quality
from millrace.llm.suffixes import OP5_SQL, op5_suffix_repeats
from millrace.llm.urls import OP6_SQL, op6_url_filters
from millrace.llm.wavelet import op2_wavelet_tokens


def queries() -> dict:
    return {
        "op1_licences": op1_licences,
        "op2_wavelet_tokens": op2_wavelet_tokens,
        "op3_media": op3_media,
        "op4_quality": op4_quality,
        "op5_suffix_repeats": op5_suffix_repeats,
        "op6_url_filters": op6_url_filters,
        "op7_ngram_jaccard": op7_ngram_jaccard,
        "op8_packing": op8_packing,
        "op9_bpe": op9_bpe,
        "op10_pseudo_likelihood": op10_pseudo_likelihood,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_quality": OP4_SQL, "op5_suffix_repeats": OP5_SQL, "op6_url_filters": OP6_SQL, "op7_ngram_jaccard": OP7_SQL}
