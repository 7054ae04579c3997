"""clickforge.operators."""
