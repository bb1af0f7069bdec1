"""Scoring of trajectories as they arrive."""
