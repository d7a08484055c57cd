"""End-to-end plans: raw-file fixtures, ingest, normalize, questions."""
