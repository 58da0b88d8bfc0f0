"""Composite operators built from DataFrame primitives (dedup, scalable windows,
incremental loads, load metrics)."""
