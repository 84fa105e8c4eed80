"""clickflow: Spark-native clickstream ELT operators.

Every public operator is a plain function over DataFrames (``DataFrame -> DataFrame``)
so that Catalyst sees the whole plan: filters reach the Parquet scan, projections are
pruned, and the only shuffles are the ones the semantics need.
"""

__version__ = "0.1.0"

from clickflow.operators.attempts import (attempt_message, classify_attempt, extract_name,  # noqa: E402
                                          resolve_attempts, result_log)
from clickflow.operators.candidates import (candidates, count_products, exclude_finished,  # noqa: E402
                                            finished_ids, finished_union, first_url, next_round, pending_count)
from clickflow.operators.events import resolve_product_id, resolve_url, slice_after, tag_event_group  # noqa: E402
from clickflow.operators.export import (assign_chunks, chunk_manifest, export_parts,  # noqa: E402
                                        incremental_export, load_state, ordered_export, row_numbers)
from clickflow.operators.geo import count_ips, locate_ips, overlapping_ranges, unique_ips  # noqa: E402
from clickflow.operators.profile import catalog_columns, profile  # noqa: E402
from clickflow.operators.quality import (normalize_location, normalize_product, split_valid,  # noqa: E402
                                         validate_location, validate_product)
from clickflow.operators.reports import (chunk_progress, crawl_report, ip_progress, ip_report,  # noqa: E402
                                         outcome_counts, quality_counts)
from clickflow.operators.standardize import detect_nested, nested_to_json, standardize  # noqa: E402
from clickflow.operators.warehouse import align_to, create_from, load_full, load_part, merge_insert_only  # noqa: E402

__all__ = [
    "align_to", "assign_chunks", "attempt_message", "candidates", "catalog_columns", "chunk_manifest",
    "chunk_progress", "classify_attempt", "count_ips", "count_products", "crawl_report", "create_from",
    "detect_nested", "exclude_finished", "export_parts", "extract_name", "finished_ids", "finished_union",
    "first_url", "incremental_export", "ip_progress", "ip_report", "load_full", "load_part", "load_state",
    "locate_ips", "merge_insert_only", "nested_to_json", "next_round", "normalize_location",
    "normalize_product", "ordered_export", "outcome_counts", "overlapping_ranges", "pending_count",
    "profile", "quality_counts", "resolve_attempts", "resolve_product_id", "resolve_url", "result_log",
    "row_numbers", "slice_after", "split_valid", "standardize", "tag_event_group", "unique_ips",
    "validate_location", "validate_product",
]
