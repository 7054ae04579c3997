"""clickforge.streaming."""
