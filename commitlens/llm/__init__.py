"""Training-data operators: deduplication, packing, tokenisation, search
and scoring of documents.  Nothing outside this package imports it."""
