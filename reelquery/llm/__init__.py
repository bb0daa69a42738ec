"""Operators for training-data pipelines. Nothing else in reelquery imports this package."""
