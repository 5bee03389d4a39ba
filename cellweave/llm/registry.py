"""Queries of this subpackage for the driver's entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellweave.llm import annforest, bpe, centroids, langid, licences, neardup, packing, periods, pivots, quality, rules, secrets, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licence_classifier": licences.query,
    "op2_best_fit_packing": packing.query,
    "op3_minhash_near_duplicates": neardup.query,
    "op4_secret_ownership": secrets.query,
    "op5_bpe_codec": bpe.query,
    "op6_language_id": langid.query,
    "op7_warc_chunks": warc.query,
    "op8_hash_prefix_forest": annforest.query,
    "op9_quality_rules": rules.query,
    "op10_quality_classifier": quality.query,
    "op11_orchard_clusters": centroids.query,
    "op12_pivot_top_k": pivots.query,
    "op13_periodic_runs": periods.query,
}

ORACLE_SQL: dict[str, str] = {
    "op11_orchard_clusters": centroids.ORACLE_SQL,
    "op12_pivot_top_k": pivots.ORACLE_SQL,
}
