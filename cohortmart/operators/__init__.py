"""DataFrame operators: visit selection, reshaping, identity, quality, anonymization."""
