"""cohortlens: player-cohort analytics on Spark (features, revenue model, reports, segments, campaigns)."""

# Part of the model-registry key used by the registered scoring queries: bump it whenever model
# training changes, so that models saved by an older version are not reused.
__version__ = "0.1.0"
