"""Reading inputs, writing results, reports and fitted state."""

from featurelab.sources.scratch import scratch_path, stage
from featurelab.sources.sinks import (
    append_dropped,
    read_dropped,
    save_splits,
    write_manifest,
    write_report,
    write_single_file,
    write_table,
)
from featurelab.sources.tables import read_input, read_parquet, read_table

__all__ = [
    "append_dropped",
    "read_dropped",
    "read_input",
    "read_parquet",
    "read_table",
    "save_splits",
    "scratch_path",
    "stage",
    "write_manifest",
    "write_report",
    "write_single_file",
    "write_table",
]
