"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import (ann, decontam, html_text, kmeans, langid, mixing, neardup, pseudonyms, quality, repeats, sharding, spelling,
               toolcalls)

QUERIES = {
    "op1_tool_calls": toolcalls.op1,
    "op2_html_text": html_text.op2,
    "op3_nearest_neighbours": ann.op3,
    "op4_decontamination": decontam.op4,
    "op5_quality_classifier": quality.op5,
    "op6_sharding": sharding.op6,
    "op7_pseudonyms": pseudonyms.op7,
    "op8_language_id": langid.op8,
    "op9_minhash_neardup": neardup.op9,
    "op10_mixing": mixing.op10,
    "op11_repeats": repeats.op11,
    "op12_spelling": spelling.op12,
    "op13_centroids": kmeans.op13,
}

ORACLE = {
    "op1_tool_calls": toolcalls.SQL,
    "op10_mixing": mixing.SQL,
    "op11_repeats": repeats.SQL,
    "op12_spelling": spelling.SQL,
    "op13_centroids": kmeans.SQL,
}
