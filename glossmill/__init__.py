"""glossmill: localisation and terminology analytics as Spark jobs."""
