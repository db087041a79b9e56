"""Contract queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from claimtide.llm.bpe import op1_byte_bpe
from claimtide.llm.decontamination import OP13_SQL, op13_wu_manber_decontamination
from claimtide.llm.exact_dedup import OP8_SQL, op8_digest_index
from claimtide.llm.importance import OP11_SQL, op11_importance_resampling
from claimtide.llm.license_scan import OP2_SQL, op2_license_scan
from claimtide.llm.near_dedup import OP6_SQL, op6_setsketch_near_dedup
from claimtide.llm.packing import op4_dp_packing
from claimtide.llm.pii import op7_weak_pii
from claimtide.llm.quality_rules import OP5_SQL, op5_risk_controlled_quality
from claimtide.llm.secret_scan import op9_assignment_secrets
from claimtide.llm.sharding import OP10_SQL, op10_interleaved_shards
from claimtide.llm.toxicity import op3_counterfactual_toxicity
from claimtide.llm.whitening import op12_feast_whitening

QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_license_scan": op2_license_scan,
    "op3_counterfactual_toxicity": op3_counterfactual_toxicity,
    "op4_dp_packing": op4_dp_packing,
    "op5_risk_controlled_quality": op5_risk_controlled_quality,
    "op6_setsketch_near_dedup": op6_setsketch_near_dedup,
    "op7_weak_pii": op7_weak_pii,
    "op8_digest_index": op8_digest_index,
    "op9_assignment_secrets": op9_assignment_secrets,
    "op10_interleaved_shards": op10_interleaved_shards,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_feast_whitening": op12_feast_whitening,
    "op13_wu_manber_decontamination": op13_wu_manber_decontamination,
}

#: queries that SQL can express; the others are tested against brute force.
SQL: dict[str, str] = {
    "op2_license_scan": OP2_SQL,
    "op5_risk_controlled_quality": OP5_SQL,
    "op6_setsketch_near_dedup": OP6_SQL,
    "op8_digest_index": OP8_SQL,
    "op10_interleaved_shards": OP10_SQL,
    "op11_importance_resampling": OP11_SQL,
    "op13_wu_manber_decontamination": OP13_SQL,
}
