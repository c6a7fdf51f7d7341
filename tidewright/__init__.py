"""Spark-native curation engine for social-video, speech and text datasets."""
