"""Collections: scans, stored snapshots and their write verbs."""
