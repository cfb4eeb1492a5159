"""fitmesh: tabular regression and model selection as Spark jobs."""

__version__ = "0.1.0"
