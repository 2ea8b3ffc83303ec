"""Whole jobs: training, prediction, the command line and the query catalogue."""
