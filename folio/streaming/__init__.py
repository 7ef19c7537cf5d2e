"""The query model has no streaming operator."""
