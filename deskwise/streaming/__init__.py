"""Stream jobs that share the batch functions."""
