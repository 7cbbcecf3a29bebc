"""The queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from dayledger.llm import op10_bpe as o10
from dayledger.llm import op11_spelling_groups as o11
from dayledger.llm import op12_vantage_clusters as o12
from dayledger.llm import op13_bottom_sketches as o13
from dayledger.llm import op1_quality as o1
from dayledger.llm import op2_warc as o2
from dayledger.llm import op3_token_counts as o3
from dayledger.llm import op4_signature_tree as o4
from dayledger.llm import op5_substring_dedup as o5
from dayledger.llm import op6_lattice_lm as o6
from dayledger.llm import op7_decontaminate as o7
from dayledger.llm import op8_token_files as o8
from dayledger.llm import op9_nearest as o9

QUERIES = {
    "op1_quality": o1.op1_quality,
    "op7_decontaminate": o7.op7_decontaminate,
    "op5_substring_dedup": o5.op5_substring_dedup,
    "op4_signature_tree": o4.op4_signature_tree,
    "op6_lattice_lm": o6.op6_lattice_lm,
    "op10_bpe": o10.op10_bpe,
    "op8_token_files": o8.op8_token_files,
    "op3_token_counts": o3.op3_token_counts,
    "op2_warc": o2.op2_warc,
    "op9_nearest": o9.op9_nearest,
    "op11_spelling_groups": o11.op11_spelling_groups,
    "op12_vantage_clusters": o12.op12_vantage_clusters,
    "op13_bottom_sketches": o13.op13_bottom_sketches,
}
SQL = {
    "op2_warc": o2.SQL,
    "op9_nearest": o9.SQL,
    "op12_vantage_clusters": o12.SQL,
}
