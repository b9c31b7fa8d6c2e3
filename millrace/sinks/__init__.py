"""Console, database and table sinks."""
