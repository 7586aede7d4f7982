"""Compare two versions of a set of tables on Spark and bring them together.

``target`` is what should be there, ``given`` is what is being audited; every function takes them in this order.
"""

from driftmend.operators.buckets import bucket_diff, bucket_digest, differing_buckets, digest_diff
from driftmend.operators.digest_tree import (
    differing_leaves,
    digest_tree,
    read_branches,
    save_branches,
    tree_diff,
    update_tree,
)
from driftmend.operators.discovery import key_columns, propose_references
from driftmend.operators.keys import (
    key_presence,
    key_profile,
    missing_keys,
    orphan_keys,
    orphan_rows,
    primary_key_holds,
    scan_keys,
    unsynced_count,
)
from driftmend.operators.mapping import map_schema
from driftmend.operators.merge import merge_bidirectional
from driftmend.operators.rows import (
    bag_diff,
    change_log,
    conflicts,
    observed_nullability,
    row_diff,
    row_pairs,
    status_counts,
)
from driftmend.operators.sync import incremental_sync, rows_to_delete, rows_to_insert, sync, sync_candidates
from driftmend.operators.three_way import keep_base, merge_three_way, three_way_status, true_conflicts
from driftmend.plans.audit import audit, audit_metrics, reverse_check
from driftmend.plans.facts import column_facts, with_affected
from driftmend.plans.files import FileSync, run_file_sync
from driftmend.plans.schema_sync import SchemaSync, consequent_orphans, run_schema_sync, sync_schema
from driftmend.plans.sync import run_sync
from driftmend.sources.catalog import (
    Catalog,
    list_columns,
    list_foreign_keys,
    list_primary_keys,
    list_tables,
    load_catalog,
    table_exists,
)
from driftmend.sources.contract import Namespace, Reference, TableContract
from driftmend.sources.manifest import file_changes, read_state, register_files
from driftmend.sources.readers import read_database, read_files, read_jdbc
from driftmend.sources.sinks import copy_once, copy_runs, copy_table, read_copied, write_findings
from driftmend.streaming.arrivals import late_rows, read_arrivals, rejected_rows, stream_sync, synced_state

__all__ = [
    "Catalog",
    "FileSync",
    "Namespace",
    "Reference",
    "SchemaSync",
    "TableContract",
    "audit",
    "audit_metrics",
    "bag_diff",
    "bucket_diff",
    "bucket_digest",
    "change_log",
    "column_facts",
    "conflicts",
    "consequent_orphans",
    "copy_once",
    "copy_runs",
    "copy_table",
    "differing_buckets",
    "differing_leaves",
    "digest_diff",
    "digest_tree",
    "file_changes",
    "incremental_sync",
    "keep_base",
    "key_columns",
    "key_presence",
    "key_profile",
    "late_rows",
    "list_columns",
    "list_foreign_keys",
    "list_primary_keys",
    "list_tables",
    "load_catalog",
    "map_schema",
    "merge_bidirectional",
    "merge_three_way",
    "missing_keys",
    "observed_nullability",
    "orphan_keys",
    "orphan_rows",
    "primary_key_holds",
    "propose_references",
    "read_arrivals",
    "read_branches",
    "read_database",
    "read_copied",
    "read_files",
    "read_jdbc",
    "read_state",
    "register_files",
    "rejected_rows",
    "reverse_check",
    "row_diff",
    "row_pairs",
    "rows_to_delete",
    "rows_to_insert",
    "run_file_sync",
    "run_schema_sync",
    "run_sync",
    "save_branches",
    "scan_keys",
    "status_counts",
    "stream_sync",
    "sync",
    "sync_candidates",
    "sync_schema",
    "synced_state",
    "table_exists",
    "three_way_status",
    "tree_diff",
    "true_conflicts",
    "unsynced_count",
    "update_tree",
    "with_affected",
    "write_findings",
]
