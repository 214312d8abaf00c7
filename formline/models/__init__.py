"""Feature stages, regressors, training runs and the trial table."""
