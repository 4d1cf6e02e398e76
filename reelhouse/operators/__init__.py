"""DataFrame-to-DataFrame operators: lazy, deterministic, no driver-side keys."""
