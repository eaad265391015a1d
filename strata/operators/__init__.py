"""Relational operators built from DataFrame primitives: lookup joins, top-k per
group, keyed upsert and incremental loads, type-2 history, metrics and checks."""
