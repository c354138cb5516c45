"""DataFrame -> DataFrame operators: markup extraction, pagination, records, language
identification, fetch-attempt resolution, reconciliation, and the join/partitioning helpers."""
