"""DataFrame-to-DataFrame operators and ready-made analysis jobs on Spark."""
