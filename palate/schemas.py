"""Explicit schemas: CSV is never inferred, so both ingest routes give the same types."""

# imdbId carries leading zeros, so it stays text.
BRONZE = {
    "ratings": "userId BIGINT, movieId BIGINT, rating DOUBLE, timestamp BIGINT",
    "movies": "movieId BIGINT, title STRING, genres STRING",
    "tags": "userId BIGINT, movieId BIGINT, tag STRING, timestamp BIGINT",
    "genome_scores": "movieId BIGINT, tagId BIGINT, relevance DOUBLE",
    "genome_tags": "tagId BIGINT, tag STRING",
    "links": "movieId BIGINT, imdbId STRING, tmdbId BIGINT",
}
