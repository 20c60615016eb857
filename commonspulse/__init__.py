"""Public-activity analytics on Spark: panels, portfolio views, cutoff measures and exports."""
