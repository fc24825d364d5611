"""Whole plans: the job on tables, the read side, and the registered queries."""
