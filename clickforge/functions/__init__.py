"""clickforge.functions."""
