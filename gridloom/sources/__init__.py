"""Reading files and grids, writing tables and sheets."""
