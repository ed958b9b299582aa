"""One registered query per operator, over the whole table it is meant for."""
from __future__ import annotations

from . import bpe_codec, decontaminate, host_quality, pii, prefix_trie, ring, search, secrets, simhash, token_counts, tokens, url_templates, warc

QUERIES = {
    "op1_host_quality_rules": host_quality.op1_host_quality_rules,
    "op2_bounded_load_ring": ring.op2_bounded_load_ring,
    "op3_warc_round_trip": warc.op3_warc_round_trip,
    "op4_viterbi_token_counts": token_counts.op4_viterbi_token_counts,
    "op5_url_template_tree": url_templates.op5_url_template_tree,
    "op6_token_files": tokens.op6_token_files,
    "op7_credential_linking": secrets.op7_credential_linking,
    "op8_bpe_tree_concatenation": bpe_codec.op8_bpe_tree_concatenation,
    "op9_simhash_near_dedup": simhash.op9_simhash_near_dedup,
    "op10_benchmark_decontamination": decontaminate.op10_benchmark_decontamination,
    "op11_personal_data": pii.op11_personal_data,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_ranked_search": search.op13_ranked_search,
}

ORACLES = {
    "op1_host_quality_rules": host_quality.OP1_SQL,
    "op3_warc_round_trip": warc.OP3_SQL,
    "op5_url_template_tree": url_templates.OP5_SQL,
    "op7_credential_linking": secrets.OP7_SQL,
    "op11_personal_data": pii.OP11_SQL,
    "op12_prefix_trie": prefix_trie.OP12_SQL,
    "op13_ranked_search": search.OP13_SQL,
}
