"""Column expressions: caption text, fetch outcomes, metadata fields."""
