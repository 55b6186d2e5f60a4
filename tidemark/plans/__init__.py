"""The jobs a user runs: marts, reports, publish, promote, export, compaction, logs."""
