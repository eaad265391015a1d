"""Inputs and stored state: raw table schemas and readers, seed lookups, the
stand-in views over the test tables, and the versioned table store."""
