"""assaykit: dataset quality, duplicate handling, model evaluation and ranking as Spark jobs."""
