"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

from __future__ import annotations

from . import centroids, curriculum, ranked_search
from .centroids import op13_centroids
from .curriculum import op4_curriculum
from .license_scan import op8_license_scan
from .multiset_hash import op7_multiset_hash
from .packing import op9_packing
from .pii_feistel import op3_pii_feistel
from .preference import op6_preference
from .prob_minhash import op10_prob_minhash
from .quality_crf import op1_quality_crf
from .ranked_search import op12_ranked_search
from .suffix_dedup import op2_suffix_dedup
from .toxicity_kn import op5_toxicity_kn
from .url_filter import op11_url_filter

_QUERIES = (op1_quality_crf, op2_suffix_dedup, op3_pii_feistel, op4_curriculum, op5_toxicity_kn, op6_preference, op7_multiset_hash, op8_license_scan, op9_packing, op10_prob_minhash, op11_url_filter, op12_ranked_search, op13_centroids)


def queries() -> dict:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict:
    return {"op4_curriculum": curriculum.ORACLE, "op12_ranked_search": ranked_search.ORACLE, "op13_centroids": centroids.ORACLE}
