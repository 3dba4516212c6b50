"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from fleetlens.llm.embedding_dedup import q_embedding_dedup
from fleetlens.llm.fm_quality import q_quality
from fleetlens.llm.line_dedup import q_line_dedup
from fleetlens.llm.ngram_join import q_ngram_join
from fleetlens.llm.packing import q_packing
from fleetlens.llm.phrase_mining import PHRASES_SQL, q_phrase_mining
from fleetlens.llm.prefix_trie import q_prefix_trie
from fleetlens.llm.simhash import q_fingerprints
from fleetlens.llm.sp_tokenizer import q_sentencepiece
from fleetlens.llm.substring_dedup import q_substring_dedup
from fleetlens.llm.token_binary import q_token_binary
from fleetlens.llm.token_counts import q_token_counts
from fleetlens.llm.toxicity_chain import q_toxicity

QUERIES = {
    "op1_quality": q_quality,
    "op2_ngram_join": q_ngram_join,
    "op3_fingerprints": q_fingerprints,
    "op4_line_dedup": q_line_dedup,
    "op5_packing": q_packing,
    "op6_substring_dedup": q_substring_dedup,
    "op7_sentencepiece": q_sentencepiece,
    "op8_toxicity": q_toxicity,
    "op9_embedding_dedup": q_embedding_dedup,
    "op10_token_binary": q_token_binary,
    "op11_token_counts": q_token_counts,
    "op12_phrase_mining": q_phrase_mining,
    "op13_prefix_trie": q_prefix_trie,
}

ORACLES: dict[str, str] = {"op12_phrase_mining": PHRASES_SQL}
