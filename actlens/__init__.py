"""actlens: legal-act analytics and corpus preparation on Spark DataFrames."""
