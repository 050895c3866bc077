"""Streaming: intentionally empty.

The analytics this package rebuilds have no streaming behaviour (no watermarks, windows over event
time, or stateful operators); the nearest thing is a scheduled daily batch, which is
``plans.jobs.score_and_publish`` re-run per cohort date, and late data is handled by re-running a
cohort (``plans.jobs.backfill``). No streaming operator is added beyond what the analytics do.
"""
