"""Row validation, cleaning, table merges, dimension history, quality checks."""
