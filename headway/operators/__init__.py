"""DataFrame-to-DataFrame operators: keep-latest, ordered neighbours, change tracking, quality gates."""
