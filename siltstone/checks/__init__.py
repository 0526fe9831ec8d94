"""Data-quality checks: every check returns its failing rows, none when it passes."""
