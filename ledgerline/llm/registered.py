"""The queries of this subpackage and, where SQL can express one, its DuckDB SQL."""

from . import byte_bpe, fingerprints, html_text, language, merkle, mixing, quality, repeats, secrets, simhash, token_counts, toxicity, trie

QUERIES = {
    "op9_language": language.op9_language,
    "op8_html_text": html_text.op8_html_text,
    "op3_toxicity": toxicity.op3_toxicity,
    "op10_fingerprints": fingerprints.op10_fingerprints,
    "op1_quality_rules": quality.op1_quality_rules,
    "op5_secrets": secrets.op5_secrets,
    "op2_token_counts": token_counts.op2_token_counts,
    "op4_simhash": simhash.op4_simhash,
    "op6_mixing": mixing.op6_mixing,
    "op7_byte_bpe": byte_bpe.op7_byte_bpe,
    "op11_merkle": merkle.op11_merkle,
    "op12_repeats": repeats.op12_repeats,
    "op13_prefix_trie": trie.op13_prefix_trie,
}

ORACLES = {
    "op1_quality_rules": quality.OP1_SQL,
    "op5_secrets": secrets.OP5_SQL,
    "op6_mixing": mixing.OP6_SQL,
    "op11_merkle": merkle.OP11_SQL,
    "op12_repeats": repeats.OP12_SQL,
    "op13_prefix_trie": trie.OP13_SQL,
}
