"""Per-entity, per-period statistics on Spark: assembly, lagged features, models and rosters."""
