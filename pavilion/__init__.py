"""Match analytics on Spark: innings roll-ups, leakage-free form, ranking, models."""
