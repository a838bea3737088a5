"""The queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from .decontamination import op4_simhash_decontamination
from .fingerprints import op7_scaled_fingerprints
from .html import op3_tree_scoring
from .minhash import OP1_SQL, op1_minhash_forest
from .mixing import OP10_SQL, op10_poisson_mixing
from .pii import op8_pii
from .quality import op6_compression_quality
from .sharding import OP5_SQL, op5_sharding
from .suffixes import OP2_SQL, op2_suffix_dedup
from .tokens import op9_wavelet_tokens

QUERIES = {
    "op1_minhash_forest": op1_minhash_forest,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_tree_scoring": op3_tree_scoring,
    "op4_simhash_decontamination": op4_simhash_decontamination,
    "op5_sharding": op5_sharding,
    "op6_compression_quality": op6_compression_quality,
    "op7_scaled_fingerprints": op7_scaled_fingerprints,
    "op8_pii": op8_pii,
    "op9_wavelet_tokens": op9_wavelet_tokens,
    "op10_poisson_mixing": op10_poisson_mixing,
}

ORACLES = {
    "op1_minhash_forest": OP1_SQL,
    "op2_suffix_dedup": OP2_SQL,
    "op5_sharding": OP5_SQL,
    "op10_poisson_mixing": OP10_SQL,
}
