"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from claimforge.llm.byte_bpe import op5_byte_bpe
from claimforge.llm.decontamination import OP12_SQL, op12_decontamination
from claimforge.llm.imatch import op1_imatch
from claimforge.llm.jaccard_join import OP8_SQL, op8_jaccard_join
from claimforge.llm.knn_quality import op4_knn_quality
from claimforge.llm.mixing import OP3_SQL, op3_mixing
from claimforge.llm.pivot_clusters import OP11_SQL, op11_pivot_clusters
from claimforge.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from claimforge.llm.pseudonyms import op6_pseudonyms
from claimforge.llm.quality_rules import OP9_SQL, op9_rules
from claimforge.llm.shards import op2_shards
from claimforge.llm.token_files import op7_token_files
from claimforge.llm.toxicity import op10_toxicity

QUERIES = {
    "op1_imatch": op1_imatch,
    "op2_shards": op2_shards,
    "op3_mixing": op3_mixing,
    "op4_knn_quality": op4_knn_quality,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_token_files": op7_token_files,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_rules": op9_rules,
    "op10_toxicity": op10_toxicity,
    "op11_pivot_clusters": op11_pivot_clusters,
    "op12_decontamination": op12_decontamination,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLES = {
    "op3_mixing": OP3_SQL,
    "op8_jaccard_join": OP8_SQL,
    "op9_rules": OP9_SQL,
    "op11_pivot_clusters": OP11_SQL,
    "op12_decontamination": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
