"""Sources and sinks: landed tables, sparse cell grids, the dataset contract."""
