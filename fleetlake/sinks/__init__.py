"""Writers: whole-table overwrite, partitioned overwrite, layer DDL."""
