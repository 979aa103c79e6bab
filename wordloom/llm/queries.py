"""Queries of the operators, by registered name, and their SQL where there is one."""

from __future__ import annotations

from wordloom.llm.bpe import op2_bpe
from wordloom.llm.divergence import OP11_SQL, op11_divergence
from wordloom.llm.language_model import op3_lattice_score
from wordloom.llm.lines import OP9_SQL, op9_line_dedup
from wordloom.llm.mixing import OP1_SQL, op1_mixing
from wordloom.llm.neighbours import OP8_SQL, op8_neighbours
from wordloom.llm.prefix_trie import OP12_SQL, op12_prefix_trie
from wordloom.llm.quality import op5_fertility
from wordloom.llm.simhash import op4_simhash
from wordloom.llm.super_minhash import OP13_SQL, op13_super_minhash
from wordloom.llm.surrogates import op7_surrogates
from wordloom.llm.toxicity import op10_toxicity
from wordloom.llm.token_counts import op6_token_counts

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_bpe": op2_bpe,
    "op3_lattice_score": op3_lattice_score,
    "op4_simhash": op4_simhash,
    "op5_fertility": op5_fertility,
    "op6_token_counts": op6_token_counts,
    "op7_surrogates": op7_surrogates,
    "op8_neighbours": op8_neighbours,
    "op9_line_dedup": op9_line_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_divergence": op11_divergence,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_super_minhash": op13_super_minhash,
}

SQL: dict[str, str] = {
    "op1_mixing": OP1_SQL,
    "op8_neighbours": OP8_SQL,
    "op9_line_dedup": OP9_SQL,
    "op11_divergence": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_super_minhash": OP13_SQL,
}
