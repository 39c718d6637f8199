"""First-click attribution and click/checkout analytics as Spark jobs."""
