"""textmill: preparing and checking text corpora as Spark jobs."""
