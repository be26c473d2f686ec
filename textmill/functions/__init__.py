"""Column functions: narrow, row-local, usable on batches and on streams."""
