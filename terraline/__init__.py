"""terraline: fleet telemetry, terrain and audit analytics on Spark DataFrames."""
