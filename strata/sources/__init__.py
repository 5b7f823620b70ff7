"""Reading and writing: raw files, catalog tables, snapshots, partitions, run records."""
