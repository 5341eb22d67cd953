"""ledgerloom: audit, transform and verify snapshots of authenticated key-value state with Spark."""
