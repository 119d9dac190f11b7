"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from .decontamination import op9_decontamination
from .hardnegatives import HARD_NEGATIVES_SQL, op13_hard_negatives
from .jaccard import op5_jaccard_join
from .licenses import license_sql, op11_license_join
from .lines import op3_line_dedup
from .neighbours import op6_nearest_neighbours
from .packing import op8_packed_sequences
from .periodic import op12_periodic_runs
from .pii import op4_feistel_pseudonyms
from .quality import op10_quality_classifier
from .sharding import op1_minimax_shards
from .tokens import op2_token_counts
from .warc import op7_warc_capture_index

QUERIES: dict[str, Callable] = {
    "op1_minimax_shards": op1_minimax_shards,
    "op2_token_counts": op2_token_counts,
    "op3_line_dedup": op3_line_dedup,
    "op4_feistel_pseudonyms": op4_feistel_pseudonyms,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_warc_capture_index": op7_warc_capture_index,
    "op8_packed_sequences": op8_packed_sequences,
    "op9_decontamination": op9_decontamination,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_license_join": op11_license_join,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_hard_negatives": op13_hard_negatives,
}

# Archives are written and read back, but what a page's record says depends on
# the pages alone.  Licenses and hard negatives have brute-force SQL.  The other queries depend on tokenizers, trained models or
# keyed hashes, or walk graphs and sequences that SQL has no whole-table form
# for; tests/llm compares them with brute-force versions.
SQL: dict[str, str] = {
    "op7_warc_capture_index": """
        WITH p AS (
            SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        f AS (
            SELECT payload_digest, min(page_id) AS first
            FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT p.page_id, p.payload_bytes, p.payload_digest,
               CASE WHEN f.first < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN f.first < p.page_id THEN f.first END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)
    """,
    "op11_license_join": license_sql(),
    "op13_hard_negatives": HARD_NEGATIVES_SQL,
}
