"""Plan-level helpers: shared storage, parallelism and hot-key handling."""
