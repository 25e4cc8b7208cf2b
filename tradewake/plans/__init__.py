"""One transform per job: DataFrames in, DataFrames out, for batch and streams."""
