"""Cutoffs, origins and plan snapshots."""
