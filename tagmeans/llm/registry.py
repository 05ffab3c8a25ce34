"""The subpackage's registered queries and their SQL, by name."""

from __future__ import annotations

from . import (collocations, decontamination, html_text, licenses, mixing, neighbours, pii, quality, simhash, spans,
               token_output, toxicity, trie)

QUERIES = {
    "op1_licenses": licenses.query,
    "op2_simhash": simhash.query,
    "op3_html_text": html_text.query,
    "op4_neighbours": neighbours.query,
    "op5_mixing": mixing.query,
    "op6_quality": quality.query,
    "op7_decontamination": decontamination.query,
    "op8_token_output": token_output.query,
    "op9_pii": pii.query,
    "op10_repeated_spans": spans.query,
    "op11_collocations": collocations.query,
    "op12_conversation_trie": trie.query,
    "op13_toxicity": toxicity.query,
}
ORACLES = {"op1_licenses": licenses.oracle(), "op7_decontamination": decontamination.ORACLE,
           "op11_collocations": collocations.ORACLE, "op12_conversation_trie": trie.ORACLE}
