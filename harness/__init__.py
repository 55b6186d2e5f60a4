"""Driver-facing wiring: input mappings over the test tables, the query registry and the oracle texts."""
