"""Training-data operators: joins, deduplication, scans, rules, formatting, scoring, encoding and mixing of documents."""
