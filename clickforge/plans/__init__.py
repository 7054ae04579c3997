"""clickforge.plans."""
