"""The jobs: each takes and returns DataFrames, only ``daily_run`` touches storage."""
