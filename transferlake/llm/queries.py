"""Queries of the llm operators and their oracle SQL."""

from __future__ import annotations

from transferlake.llm.codes import op13_vector_codes
from transferlake.llm.decontamination import OP2_SQL, op2_decontamination
from transferlake.llm.fingerprints import op5_fingerprints
from transferlake.llm.jaccard import OP10_SQL, op10_jaccard_join
from transferlake.llm.language import op6_language
from transferlake.llm.mixing import op4_mixing
from transferlake.llm.quality import op8_quality
from transferlake.llm.rules import op11_quality_rules
from transferlake.llm.secrets import op9_secrets
from transferlake.llm.sharding import op7_sharding
from transferlake.llm.toxicity import op1_toxicity
from transferlake.llm.warc import OP3_SQL, op3_warc
from transferlake.llm.whitening import op12_whitening

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_warc": op3_warc,
    "op4_mixing": op4_mixing,
    "op5_fingerprints": op5_fingerprints,
    "op6_language": op6_language,
    "op7_sharding": op7_sharding,
    "op8_quality": op8_quality,
    "op9_secrets": op9_secrets,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_quality_rules": op11_quality_rules,
    "op12_whitening": op12_whitening,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE: dict[str, str] = {
    "op2_decontamination": OP2_SQL,
    "op3_warc": OP3_SQL,
    "op10_jaccard_join": OP10_SQL,
}
