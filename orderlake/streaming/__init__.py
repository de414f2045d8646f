"""Stream ingest."""
