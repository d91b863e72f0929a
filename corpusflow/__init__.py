"""Spark jobs for the life-cycle of post-training corpora."""
