"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

import corpus_pipeline
from tallyloom.llm import (op1_secrets, op2_quality, op3_token_rollups, op4_pseudonyms, op5_packing, op6_perspectives, op7_simhash, op8_multiprobe,
                           op9_pieces, op10_kd_shards, op11_warc, op12_centroids, op13_divergence)

QUERIES = {
    "op1_secret_forest": op1_secrets.query,
    "op2_quality_rules": op2_quality.query,
    "op3_token_rollups": op3_token_rollups.query,
    "op4_feistel_pseudonyms": op4_pseudonyms.query,
    "op5_vector_packing": op5_packing.query,
    "op6_perspective_rotation": op6_perspectives.query,
    "op7_simhash_near_dedup": op7_simhash.query,
    "op8_multiprobe_lsh": op8_multiprobe.query,
    "op9_sentencepiece_prefix_table": op9_pieces.query,
    "op10_kd_tree_shards": op10_kd_shards.query,
    "op11_arc_to_warc": op11_warc.query,
    "op12_centroid_clusters": op12_centroids.query,
    "op13_source_divergence": op13_divergence.query,
    "pipeline": corpus_pipeline.run,
}
SQL = {"op2_quality_rules": op2_quality.SQL, "op6_perspective_rotation": op6_perspectives.SQL, "op11_arc_to_warc": op11_warc.SQL,
       "op12_centroid_clusters": op12_centroids.SQL, "op13_source_divergence": op13_divergence.SQL}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
