"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from webloom.llm.binary_output import op7_repair_ids
from webloom.llm.decontamination import op1_bm25_decontamination
from webloom.llm.hard_negatives import OP11_SQL, op11_kronecker_negatives
from webloom.llm.language_id import op8_kneser_ney_language
from webloom.llm.licences import op5_tfidf_licences
from webloom.llm.packing import op4_nnls_packing
from webloom.llm.quality import op13_zstd_quality
from webloom.llm.resampling import OP12_SQL, op12_radix_resampling
from webloom.llm.secret_scan import op3_markov_secrets
from webloom.llm.sharding import op6_permutation_shards
from webloom.llm.simhash import op10_vantage_near_dedup
from webloom.llm.topk import OP9_SQL, op9_kd_topk
from webloom.llm.toxicity import op2_pu_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bm25_decontamination": op1_bm25_decontamination,
    "op2_pu_toxicity": op2_pu_toxicity,
    "op3_markov_secrets": op3_markov_secrets,
    "op4_nnls_packing": op4_nnls_packing,
    "op5_tfidf_licences": op5_tfidf_licences,
    "op6_permutation_shards": op6_permutation_shards,
    "op7_repair_ids": op7_repair_ids,
    "op8_kneser_ney_language": op8_kneser_ney_language,
    "op9_kd_topk": op9_kd_topk,
    "op10_vantage_near_dedup": op10_vantage_near_dedup,
    "op11_kronecker_negatives": op11_kronecker_negatives,
    "op12_radix_resampling": op12_radix_resampling,
    "op13_zstd_quality": op13_zstd_quality,
}

ORACLE_SQL: dict[str, str] = {
    "op9_kd_topk": OP9_SQL,
    "op11_kronecker_negatives": OP11_SQL,
    "op12_radix_resampling": OP12_SQL,
}
