"""Compositions: analytic reports, and the jobs that build each layer's tables."""
