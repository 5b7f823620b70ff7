"""strata: table maintenance for data lakes, as Spark jobs."""

from strata.functions.casting import count_lost, fit
from strata.functions.dates import from_epoch_millis, parse_date, period_of
from strata.functions.protection import hmac_sha256, redact, rewrap, seal, unseal
from strata.operators.asof import asof_join
from strata.operators.chain import delta_chain, rebase_chain, roll_chain, snapshot_from_chain, snapshots_between
from strata.operators.conform import (
    conform,
    conform_losses,
    resolve_schema,
    schema_from_columns,
    table_schema,
    with_schema,
)
from strata.operators.diff import dataset_diff, multiset_diff, same_rows
from strata.operators.grain import GrainError, assert_grain, grain_check, grain_coverage
from strata.operators.layers import bronze_to_silver, route
from strata.operators.merge import current_state, flatten_changes, retain_last
from strata.operators.privacy import (
    pii_decrypt,
    pii_detokenize,
    pii_encrypt,
    pii_redact,
    pii_redact_known,
    pii_remove,
    pii_rewrap,
    pii_scan,
    pii_tokenize,
    vault_additions,
)
from strata.operators.product import (
    Enrichment,
    array_filter,
    attach_nested,
    nest_attribute,
    product_rollup,
    standardize,
    wide_product,
)
from strata.operators.temporal import (
    affected_partitions,
    earliest_affected,
    pit_partition,
    pit_snapshots,
    roll_forward,
    snapshot_at,
)
from strata.plans.jobs import (
    apply_changes,
    build_product,
    load_period,
    load_typed_table,
    merge_committed,
    merge_partitions,
    merge_table_partitions,
    reprocess,
    roll_snapshots,
)
from strata.plans.lineage import PartitionLineage, downstream
from strata.plans.quarantine import read_good, read_rejected, write_or_reject
from strata.plans.skew import lookup_join
from strata.session import build_session, shared_folder, working_folder
from strata.sources.commits import (
    CommitConflict,
    Version,
    commit_partitions,
    purge_commits,
    read_version,
    table_version,
)
from strata.sources.digests import dataset_diff_digest, publish_digested
from strata.sources.grain import grain_violations, publish_append, read_appends
from strata.sources.ledger import (
    RunLedger,
    read_unprocessed,
    replay_files,
    replay_range,
    unprocessed,
)
from strata.sources.manifest import FileManifest, list_files
from strata.sources.partitions import (
    purge_swapped,
    rebuild_partitions,
    rebuild_table_partitions,
    swap_table_partitions,
)
from strata.sources.raw import read_raw
from strata.sources.snapshots import (
    labelled_version,
    latest_version,
    publish_snapshot,
    purge_versions,
    read_snapshot,
)
from strata.sources.tables import (
    read_conformed,
    reads_table,
    replace_table,
    write_conformed,
    writes_table,
)
from strata.streaming.files import process_new_files
from strata.streaming.state import (
    current_state_incremental,
    current_state_partitioned,
    read_state,
)

__all__ = [
    "CommitConflict",
    "Enrichment",
    "FileManifest",
    "GrainError",
    "PartitionLineage",
    "RunLedger",
    "Version",
    "affected_partitions",
    "apply_changes",
    "array_filter",
    "asof_join",
    "assert_grain",
    "attach_nested",
    "bronze_to_silver",
    "build_product",
    "build_session",
    "commit_partitions",
    "conform",
    "conform_losses",
    "count_lost",
    "current_state",
    "current_state_incremental",
    "current_state_partitioned",
    "dataset_diff",
    "dataset_diff_digest",
    "delta_chain",
    "downstream",
    "earliest_affected",
    "fit",
    "flatten_changes",
    "from_epoch_millis",
    "grain_check",
    "grain_coverage",
    "grain_violations",
    "hmac_sha256",
    "labelled_version",
    "latest_version",
    "list_files",
    "load_period",
    "load_typed_table",
    "lookup_join",
    "merge_committed",
    "merge_partitions",
    "merge_table_partitions",
    "multiset_diff",
    "nest_attribute",
    "parse_date",
    "period_of",
    "pii_decrypt",
    "pii_detokenize",
    "pii_encrypt",
    "pii_redact",
    "pii_redact_known",
    "pii_remove",
    "pii_rewrap",
    "pii_scan",
    "pii_tokenize",
    "pit_partition",
    "pit_snapshots",
    "process_new_files",
    "product_rollup",
    "publish_append",
    "publish_digested",
    "publish_snapshot",
    "purge_commits",
    "purge_swapped",
    "purge_versions",
    "read_appends",
    "read_conformed",
    "read_good",
    "read_raw",
    "read_rejected",
    "read_snapshot",
    "read_state",
    "read_unprocessed",
    "read_version",
    "reads_table",
    "rebase_chain",
    "rebuild_partitions",
    "rebuild_table_partitions",
    "redact",
    "replace_table",
    "replay_files",
    "replay_range",
    "reprocess",
    "resolve_schema",
    "retain_last",
    "rewrap",
    "roll_chain",
    "roll_forward",
    "roll_snapshots",
    "route",
    "same_rows",
    "schema_from_columns",
    "seal",
    "shared_folder",
    "snapshot_at",
    "snapshot_from_chain",
    "snapshots_between",
    "standardize",
    "swap_table_partitions",
    "table_schema",
    "table_version",
    "unprocessed",
    "unseal",
    "vault_additions",
    "wide_product",
    "with_schema",
    "working_folder",
    "write_conformed",
    "write_or_reject",
    "writes_table",
]
