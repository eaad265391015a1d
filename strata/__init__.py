"""strata: layered analytics on Spark.

Raw tables -> typed staging views -> intermediate models -> marts (dimensions, facts),
plus keyed incremental loads, set-based upserts, type-2 history, a date spine, metrics
by dimension and time grain, and a data-quality check suite. Every model is a plain
function from DataFrames to a DataFrame, so Catalyst sees and optimises the whole plan.
"""

__version__ = "0.1.0"
