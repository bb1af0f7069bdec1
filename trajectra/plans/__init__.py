"""End-to-end plans: from raw runs or trajectories to scored, written results."""
