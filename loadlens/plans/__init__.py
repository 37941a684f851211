"""Feature sets, model building and the complete training and scoring jobs."""
