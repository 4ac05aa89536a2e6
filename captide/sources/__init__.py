"""Landing-area scans and the versioned table store."""
