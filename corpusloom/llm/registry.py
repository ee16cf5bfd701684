"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from . import decontamination, divergence, hard_negatives, license_scan, neardup, ngram_join
from .decontamination import op7_decontamination
from .divergence import op11_source_divergence
from .hard_negatives import op13_hard_negatives
from .license_scan import op2_license_scan
from .media import op4_telephony_audio
from .neardup import op1_minhash_neardup
from .ngram_join import op12_ngram_join
from .pii import op3_pii
from .quality import op6_weak_label_quality
from .sentencepiece_stream import op5_sentencepiece
from .sharding import op9_feistel_shards
from .token_counts import op8_edit_aware_counts
from .toxicity import op10_toxicity


def queries() -> dict[str, Callable]:
    return {
        "op1_minhash_neardup": op1_minhash_neardup,
        "op2_license_scan": op2_license_scan,
        "op3_pii": op3_pii,
        "op4_telephony_audio": op4_telephony_audio,
        "op5_sentencepiece": op5_sentencepiece,
        "op6_weak_label_quality": op6_weak_label_quality,
        "op7_decontamination": op7_decontamination,
        "op8_edit_aware_counts": op8_edit_aware_counts,
        "op9_feistel_shards": op9_feistel_shards,
        "op10_toxicity": op10_toxicity,
        "op11_source_divergence": op11_source_divergence,
        "op12_ngram_join": op12_ngram_join,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash_neardup": neardup.ORACLE_SQL,
        "op2_license_scan": license_scan.oracle(),
        "op7_decontamination": decontamination.ORACLE_SQL,
        "op11_source_divergence": divergence.ORACLE_SQL,
        "op12_ngram_join": ngram_join.ORACLE_SQL,
        "op13_hard_negatives": hard_negatives.ORACLE_SQL,
    }
