"""Sessions, readers and the versioned table store."""
