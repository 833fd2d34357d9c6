"""Whole preparation runs: configuration, fitting, re-applying, and the check queries."""
