"""Composed plans: the daily run and its steps, model builders, and the driver query registry with its reference SQL."""

