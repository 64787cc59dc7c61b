"""Whole-suite plans: configuration, suite, score, run."""
