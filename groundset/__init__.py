"""groundset: training records from annotated page layouts, on Spark."""
