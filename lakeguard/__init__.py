"""Contract gating, incremental upserts, data-quality/SLA checks and cost attribution on Spark."""
