"""Caption analytics on Spark: landing scans, snapshot diffs, keyed merges, text cleaning, audits."""
