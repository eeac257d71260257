"""tripgauge: trip-duration estimate accuracy on Spark DataFrames.

Entry points: ``TripEvaluation`` (the staged pipeline), ``plans.jobs`` (load /
train / score / analyse workflow steps), ``operators.*`` (DataFrame ->
DataFrame operators) and ``functions`` (Column helpers).
"""

__version__ = "0.1.0"

__all__ = ["TripEvaluation", "evaluation_for", "__version__"]


def __getattr__(name):
    if name in ("TripEvaluation", "evaluation_for"):
        from tripgauge.plans import evaluation

        return getattr(evaluation, name)
    raise AttributeError(name)
