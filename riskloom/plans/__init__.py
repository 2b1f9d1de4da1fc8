"""Compositions: the feature recipe, models, searches and the registered queries."""
