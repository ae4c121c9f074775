"""SQL column expressions shared by the operators."""

from __future__ import annotations


def third(closed_paths: str) -> str:
    """Closed paths div 3, as LONG: each 3-cycle is met from 3 nodes."""
    return f"{closed_paths} div 3"


def cells(rows: str, cell_rows: int) -> str:
    """Number of join cells for a key with ``rows`` rows: 1 for a small or NULL one."""
    return f"int(1 + coalesce({rows}, 0) div {cell_rows})"


def cell_of(spread: str, n_cells: str) -> str:
    """Cell of a row, from its own values, so that a retried task agrees."""
    return f"int(pmod(xxhash64({spread}), {n_cells}))"


def every_cell(n_cells: str) -> str:
    """One row per cell."""
    return f"explode(sequence(0, {n_cells} - 1))"
