"""DataFrame operators: numbering, sampling, dedup, ledger, cache, publishing, cost."""
