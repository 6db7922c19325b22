"""Training-data operators: licence scans, mixing, quality models, near-duplicate
joins, language-model scores, chat rendering, secret scans, packing and exact
deduplication.  Nothing else in the library imports this package."""
