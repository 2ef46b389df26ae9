"""Queries of the subpackage and the SQL that states the same results."""

from __future__ import annotations

from codexloom.llm import byte_bpe as e6
from codexloom.llm import embedding_dedup as e7
from codexloom.llm import exact_dedup as e4
from codexloom.llm import importance as e10
from codexloom.llm import language as e13
from codexloom.llm import ngram_lm as e3
from codexloom.llm import packing as e8
from codexloom.llm import phrases as e12
from codexloom.llm import runs as e11
from codexloom.llm import secrets as e9
from codexloom.llm import simhash as e2
from codexloom.llm import token_counts as e1
from codexloom.llm import toxicity as e5

QUERIES = {
    "op1_token_counts": e1.op1_token_counts,
    "op2_simhash": e2.op2_simhash,
    "op3_lm_score": e3.op3_lm_score,
    "op4_exact_dedup": e4.op4_exact_dedup,
    "op5_toxicity": e5.op5_toxicity,
    "op6_byte_bpe": e6.op6_byte_bpe,
    "op7_embedding_dedup": e7.op7_embedding_dedup,
    "op8_packing": e8.op8_packing,
    "op9_secret_scan": e9.op9_secret_scan,
    "op10_importance": e10.op10_importance,
    "op11_periodic_runs": e11.op11_periodic_runs,
    "op12_phrases": e12.op12_phrases,
    "op13_language": e13.op13_language,
}
ORACLES = {"op4_exact_dedup": e4.OP4_SQL, "op7_embedding_dedup": e7.OP7_SQL, "op12_phrases": e12.OP12_SQL}
