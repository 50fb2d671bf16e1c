"""Spark-native cleaning and k-means clustering of geographic points."""

from spheremeans.operators.assign import assign
from spheremeans.plans.grid import fit_grid
from spheremeans.plans.kmeans import Model, fit, step

__all__ = ["Model", "assign", "fit", "fit_grid", "step"]
