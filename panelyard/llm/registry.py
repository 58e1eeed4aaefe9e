"""Queries of this subpackage by name, and their SQL where SQL can express them."""

from . import chat, licenses, mixing, multiset, neardup, passages, periodic, pieces, quality, secrets, tokenfile, trie, vectors

QUERIES = {
    "op1_token_files": tokenfile.op1_token_files,
    "op2_sentencepiece": pieces.op2_sentencepiece,
    "op3_near_duplicates": neardup.op3_near_duplicates,
    "op4_near_vectors": vectors.op4_near_vectors,
    "op5_repeated_passages": passages.op5_repeated_passages,
    "op6_secret_scans": secrets.op6_secret_scans,
    "op7_license_scans": licenses.op7_license_scans,
    "op8_chat_format": chat.op8_chat_format,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_mix_sources": mixing.op10_mix_sources,
    "op11_fingerprints": multiset.op11_fingerprints,
    "op12_conversation_trie": trie.op12_conversation_trie,
    "op13_periodic_runs": periodic.op13_periodic_runs,
}
ORACLES = {"op4_near_vectors": vectors.ORACLE, "op8_chat_format": chat.ORACLE, "op9_quality_rules": quality.ORACLE, "op12_conversation_trie": trie.ORACLE}
