"""listlake: Spark jobs that turn collected listing pages into a star-schema warehouse."""
