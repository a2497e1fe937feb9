"""Silver and gold tables and reports."""
