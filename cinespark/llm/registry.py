"""Query keys of this subpackage and their DuckDB SQL."""

from cinespark.llm import (decontaminate, huffman_ids, jaccard_join, langid, lexical, mixing, negatives, packing, passages, quality_qda, quality_rules,
                           suffix_dedup, wrappers)

QUERIES = {
    "op1_host_wrappers": wrappers.op1_host_wrappers,
    "op2_chained_passages": passages.op2_chained_passages,
    "op3_huffman_ids": huffman_ids.op3_huffman_ids,
    "op4_suffix_search": decontaminate.op4_suffix_search,
    "op5_rank_order": langid.op5_rank_order,
    "op6_line_rules": quality_rules.op6_line_rules,
    "op7_bayes_join": jaccard_join.op7_bayes_join,
    "op8_quadratic": quality_qda.op8_quadratic,
    "op9_hilbert_pack": packing.op9_hilbert_pack,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
    "op11_zone_negatives": negatives.op11_zone_negatives,
    "op12_impact_search": lexical.op12_impact_search,
    "op13_weighted_mix": mixing.op13_weighted_mix,
}

ORACLES = {
    "op4_suffix_search": decontaminate.ORACLE,
    "op6_line_rules": quality_rules.ORACLE,
    "op11_zone_negatives": negatives.ORACLE,
    "op12_impact_search": lexical.ORACLE,
    "op13_weighted_mix": mixing.ORACLE,
}
