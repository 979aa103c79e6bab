"""wordloom: spelling-corpus analytics as Spark jobs."""
