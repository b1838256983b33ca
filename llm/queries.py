"""The operators over the given tables: name -> callable(spark, sf_dir), and SQL where it can say the same."""

from __future__ import annotations

from llm.byte_bpe import op1_byte_bpe
from llm import exact_search, fill_in_middle, near_dedup, resampling, sharding
from llm.fingerprints import op2_fingerprints
from llm.language import op8_language
from llm.language_model import op9_language_model
from llm.lengths import op6_length_histogram
from llm.packing import op7_packing
from llm.quality import op4_quality
from llm.training_order import op5_training_order

QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_fingerprints": op2_fingerprints,
    "op3_exact_search": exact_search.op3_exact_search,
    "op4_quality": op4_quality,
    "op5_training_order": op5_training_order,
    "op6_length_histogram": op6_length_histogram,
    "op7_packing": op7_packing,
    "op8_language": op8_language,
    "op9_language_model": op9_language_model,
    "op10_near_dedup": near_dedup.op10_near_dedup,
    "op11_fill_in_middle": fill_in_middle.op11_fill_in_middle,
    "op12_sharding": sharding.op12_sharding,
    "op13_resampling": resampling.op13_resampling,
}
SQL: dict[str, str] = {
    "op3_exact_search": exact_search.SQL,
    "op10_near_dedup": near_dedup.SQL,
    "op11_fill_in_middle": fill_in_middle.SQL,
    "op12_sharding": sharding.SQL,
    "op13_resampling": resampling.SQL,
}
