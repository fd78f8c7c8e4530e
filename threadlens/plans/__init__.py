"""The study's jobs, end to end, from the archive's tables to the result tables."""
