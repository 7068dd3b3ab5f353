"""Reading raw batches and published tables."""
