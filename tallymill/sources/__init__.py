"""Reading the input tables and writing partitioned tables."""
