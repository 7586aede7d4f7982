"""Whole audits and syncs, composed of operators."""
