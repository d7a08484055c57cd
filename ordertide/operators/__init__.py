"""Composed operators: dedupe, versioned tables, quality checks, reconciliation."""
