"""Whole flows: a policy, the steps it selects, and the SQL statements."""
