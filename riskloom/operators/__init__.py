"""Operators on whole tables: cleaning, features, profiling, splits, neighbours, evaluation."""
