"""Table schemas, the driver-table mapping, the written ledger and file I/O."""
