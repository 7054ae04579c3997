"""clickforge.models."""
