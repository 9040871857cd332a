"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from . import clusters, licenses, mixing, nearcopies, negatives, neighbours, packing, pii, quality, repeats, secrets, urls, warc

QUERIES = {
    "op1_warc_index": warc.op1_warc_index,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_embedding_join": neighbours.op3_embedding_join,
    "op4_url_rules": urls.op4_url_rules,
    "op5_source_mixing": mixing.op5_source_mixing,
    "op6_suffix_dedup": repeats.op6_suffix_dedup,
    "op7_length_packing": packing.op7_length_packing,
    "op8_quality_trees": quality.op8_quality_trees,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op10_order_minhash": nearcopies.op10_order_minhash,
    "op11_hard_negatives": negatives.op11_hard_negatives,
    "op12_drift_clusters": clusters.op12_drift_clusters,
    "op13_pii_bootstrap": pii.op13_pii_bootstrap,
}
ORACLES = {
    "op1_warc_index": warc.ORACLE_SQL,
    "op2_license_scan": licenses.ORACLE_SQL,
    "op3_embedding_join": neighbours.ORACLE_SQL,
    "op4_url_rules": urls.ORACLE_SQL,
    "op5_source_mixing": mixing.ORACLE_SQL,
    "op6_suffix_dedup": repeats.ORACLE_SQL,
    "op7_length_packing": packing.ORACLE_SQL,
    "op9_secret_scan": secrets.ORACLE_SQL,
    "op11_hard_negatives": negatives.ORACLE_SQL,
    "op12_drift_clusters": clusters.ORACLE_SQL,
    "op13_pii_bootstrap": pii.ORACLE_SQL,
}
