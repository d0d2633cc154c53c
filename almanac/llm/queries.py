"""The registered queries of this subpackage: name -> function(spark, sf_dir)."""

from __future__ import annotations

from almanac.llm.conversations import op12_conversation_repair
from almanac.llm.fingerprints import op5_minhash_fingerprints
from almanac.llm.licenses import op3_license_scan
from almanac.llm.mixing import op7_mix_sources
from almanac.llm.nearest import op8_nearest_neighbours
from almanac.llm.ngram_join import OP2_SQL, op2_ngram_jaccard_join
from almanac.llm.packing import op1_best_fit_packing
from almanac.llm.quality import op10_quality_classifier
from almanac.llm.sharding import op6_feistel_shards
from almanac.llm.spelling import op11_spelling_variants
from almanac.llm.token_counts import op9_token_counts
from almanac.llm.vector_dedup import OP13_SQL, op13_embedding_near_dedup
from almanac.llm.warc import OP4_SQL, op4_warc_round_trip

QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_ngram_jaccard_join, op3_license_scan, op4_warc_round_trip, op5_minhash_fingerprints,
    op6_feistel_shards, op7_mix_sources, op8_nearest_neighbours, op9_token_counts, op10_quality_classifier, op11_spelling_variants,
    op12_conversation_repair, op13_embedding_near_dedup)}

#: DuckDB SQL of those queries that SQL can express.
ORACLE: dict[str, str] = {op2_ngram_jaccard_join.__name__: OP2_SQL.strip(), op4_warc_round_trip.__name__: OP4_SQL.strip(),
                          op13_embedding_near_dedup.__name__: OP13_SQL.strip()}
