"""Operators: the keyed scoring model (window plan and segmented plan for
hot devices), data-quality checks and reports."""
