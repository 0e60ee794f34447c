"""regloom: regulatory rule analytics as Spark jobs.

Every public function takes DataFrames (and plain parameters) and returns a
DataFrame; nothing here holds a global session or collects data to the driver
except where a single boolean decision is the feature (promotion).
"""

__all__ = ["session"]
