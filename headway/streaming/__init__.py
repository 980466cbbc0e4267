"""Triggered streams: append ingest of feeds, and keyed change flows into type 1 and type 2 targets."""
