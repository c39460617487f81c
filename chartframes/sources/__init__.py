"""Reading, writing and profiling."""

from chartframes.sources.files import (
    cached_rows,
    cached_sketches,
    cached_source,
    read_csv,
    read_lenient,
    read_parquet,
    read_tagged,
    read_two_row_header,
    write_csv,
)
from chartframes.sources.inference import infer_types, read_inferred
from chartframes.sources.profile import describe, profile, sample_n, sample_rows
from chartframes.sources.sketches import estimates, merge_sketches, sketches
from chartframes.sources.tables import literal_table, mapping_table, unpack_list, weekdays

__all__ = [
    "cached_rows",
    "cached_sketches",
    "cached_source",
    "describe",
    "estimates",
    "infer_types",
    "literal_table",
    "mapping_table",
    "merge_sketches",
    "profile",
    "read_csv",
    "read_inferred",
    "read_lenient",
    "read_parquet",
    "read_tagged",
    "read_two_row_header",
    "sample_n",
    "sample_rows",
    "sketches",
    "unpack_list",
    "weekdays",
    "write_csv",
]
