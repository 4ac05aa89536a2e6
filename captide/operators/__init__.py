"""DataFrame-to-DataFrame operators: diffs, merges, tallies, audits, reading views."""
