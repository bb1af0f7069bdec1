"""Trajectory analytics on Spark."""
