"""Writers: table sinks (snapshots, partitioned facts, DDL) and file sinks."""
