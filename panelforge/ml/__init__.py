"""Model-study jobs: splits, preparation, estimators, grid, evaluation."""
