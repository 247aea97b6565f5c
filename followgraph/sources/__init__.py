"""Edge tables in, result files out."""

from followgraph.sources.readers import (
    EDGE_SCHEMA,
    dropped_lines,
    explain_lines,
    from_table,
    parse_lines,
    read_edges,
    read_lines,
    read_walks,
)
from followgraph.sources.scratch import scratch_path
from followgraph.sources.writers import (
    in_key_order,
    save_counted,
    save_in_order,
    write_csv,
    write_pairs,
    write_scalar,
    write_tsv,
)

__all__ = [
    "EDGE_SCHEMA",
    "dropped_lines",
    "explain_lines",
    "from_table",
    "in_key_order",
    "parse_lines",
    "read_edges",
    "read_lines",
    "read_walks",
    "save_counted",
    "save_in_order",
    "scratch_path",
    "write_csv",
    "write_pairs",
    "write_scalar",
    "write_tsv",
]
