"""Late-or-not models on large transport-leg tables, as Spark jobs.

The sub-packages follow the life of a run:

``sources``     reading raw files, staging, publishing results
``functions``   column expressions without state
``operators``   cleaning, splits, aggregates and the skew-safe lookup join
``features``    estimators fitted on training rows only
``training``    class weights, gradient descent, L-BFGS and boosted trees
``evaluation``  confusion, threshold metrics, exact ranking metrics, documents
``plans``       the three end-to-end jobs
"""
