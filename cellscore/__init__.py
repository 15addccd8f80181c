"""cellscore: label transfer, ontology scoring and label evaluation as Spark jobs."""
