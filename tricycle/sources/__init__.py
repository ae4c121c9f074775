from tricycle.sources.readers import (
    EDGE_SCHEMA,
    NODE_SCHEMA,
    edge_table,
    read_edge_lines,
    read_edges,
    read_nodes,
    read_two_paths,
)
from tricycle.sources.writers import write_counts, write_two_paths

__all__ = [
    "EDGE_SCHEMA",
    "NODE_SCHEMA",
    "edge_table",
    "read_edge_lines",
    "read_edges",
    "read_nodes",
    "read_two_paths",
    "write_counts",
    "write_two_paths",
]
