"""Streaming: intentionally empty.

The planning pipeline is a full-refresh batch job: no source is read as a
stream and no state is kept between runs, so there is no streaming operator
to provide. Every table is recomputed by ``stockflow.plans.layered``.
"""
