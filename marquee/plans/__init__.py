"""End-to-end plans (ingest, clean, profile, analyses) composed from the operators."""
