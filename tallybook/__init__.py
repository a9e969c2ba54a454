"""Analytical data-modelling operators as Spark DataFrame transformations."""
