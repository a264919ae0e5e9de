"""The daily job, one function per stage: demand, dimensions, features, model, scores."""
