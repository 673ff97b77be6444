"""Spark-native curation of agent trajectories and training text."""
