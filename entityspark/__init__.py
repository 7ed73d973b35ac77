"""Batch and incremental PySpark jobs over business directories: normalise, link, cluster, merge, score and report."""
