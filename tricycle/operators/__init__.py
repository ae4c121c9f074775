from tricycle.operators.adjacency import adjacency, adjacency_edges
from tricycle.operators.closed_paths import closed_paths_bag, closed_paths_semi
from tricycle.operators.cycles import cycle_list
from tricycle.operators.degree import follower_count, follower_count_all
from tricycle.operators.graph import Graph, prepare_graph
from tricycle.operators.pairs import pair_table, weighted_edges
from tricycle.operators.subgraph import induced_subgraph, prepare_edges
from tricycle.operators.triangles import SEMANTICS, triangle_count
from tricycle.operators.two_paths import (
    bucketed_closing_counts,
    close_two_paths,
    closing_counts,
    path_parts,
    stored_path_count,
    two_path_ends,
    two_path_count,
    two_paths,
)

__all__ = [
    "SEMANTICS",
    "Graph",
    "adjacency",
    "adjacency_edges",
    "bucketed_closing_counts",
    "close_two_paths",
    "closed_paths_bag",
    "closed_paths_semi",
    "closing_counts",
    "path_parts",
    "two_path_ends",
    "cycle_list",
    "follower_count",
    "follower_count_all",
    "induced_subgraph",
    "pair_table",
    "prepare_edges",
    "prepare_graph",
    "stored_path_count",
    "triangle_count",
    "two_path_count",
    "two_paths",
    "weighted_edges",
]
