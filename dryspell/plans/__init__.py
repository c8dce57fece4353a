"""End-to-end jobs (the reference's entry points) and the query catalogue."""
