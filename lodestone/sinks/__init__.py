"""Writers. Spark writes the rows; only documents of one row are made in a single task."""
