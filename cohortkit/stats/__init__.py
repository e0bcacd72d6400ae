"""Statistical operators: logistic models, stepwise selection, matching."""
