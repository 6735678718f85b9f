"""grainline: curate, check, profile and analyse star-schema data with Spark DataFrames."""
