"""Multi-step plans: fused table, warehouse, marts, metrics and the end-to-end run."""
