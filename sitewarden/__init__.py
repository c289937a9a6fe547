"""Multi-hazard exposure and risk scoring of point sites, on Spark DataFrames."""
