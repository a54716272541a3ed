"""Spark-native jobs for a retail-banking lakehouse: layers, history, facts, marts and checks."""
