"""Jobs composed from the operators: exports, declarative mappings, ingest."""
