"""DataFrame operators: checks, folds, merges, lookups, listings and reports."""
