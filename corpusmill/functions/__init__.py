"""Column functions: text, cleaning, flags, distances, vectors, language-model statistics, buckets."""
