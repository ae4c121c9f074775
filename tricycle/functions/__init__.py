from tricycle.functions.columns import cell_of, cells, every_cell, third

__all__ = ["cell_of", "cells", "every_cell", "third"]
