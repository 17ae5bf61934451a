"""Regression models: fitting, tuning, evaluation and scoring with MLlib and grouped Gram sums."""
