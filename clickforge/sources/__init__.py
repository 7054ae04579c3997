"""clickforge.sources."""
