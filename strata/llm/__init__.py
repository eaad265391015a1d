"""Training-data operators: dedup, archives, scans, filters, tokens, mixing.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries when it is there.
"""
