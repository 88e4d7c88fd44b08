"""DataFrame operators: flatten, dedupe, upsert, run bookkeeping, paging,
positional indexing and incremental planning."""
