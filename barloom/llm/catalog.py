"""The registered queries of this subpackage, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barloom.llm.bpe import op1_bpe
from barloom.llm.chat import OP2_SQL, op2_chat_format
from barloom.llm.containment import OP7_SQL, op7_decontamination
from barloom.llm.jaccard import OP4_SQL, op4_ngram_jaccard
from barloom.llm.licenses import op9_license_scan
from barloom.llm.lm import op6_lm_scores
from barloom.llm.neighbours import op3_nearest
from barloom.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from barloom.llm.quality import op13_quality
from barloom.llm.surrogates import op10_surrogates
from barloom.llm.token_counts import op8_token_counts
from barloom.llm.toxicity import op5_toxicity
from barloom.llm.whitening import op12_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_chat_format": op2_chat_format,
    "op3_nearest": op3_nearest,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_toxicity": op5_toxicity,
    "op6_lm_scores": op6_lm_scores,
    "op7_decontamination": op7_decontamination,
    "op8_token_counts": op8_token_counts,
    "op9_license_scan": op9_license_scan,
    "op10_surrogates": op10_surrogates,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_whitening": op12_whitening,
    "op13_quality": op13_quality,
}

ORACLES: dict[str, str] = {
    "op2_chat_format": OP2_SQL,
    "op4_ngram_jaccard": OP4_SQL,
    "op7_decontamination": OP7_SQL,
    "op11_prefix_trie": OP11_SQL,
}
