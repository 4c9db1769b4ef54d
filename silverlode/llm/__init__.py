"""Training-data operators: deduplication, filters, classifiers, tokens, vectors and mixing."""
