"""Business jobs, composed from sources, functions and operators.

``clickwave.plans.catalog`` registers them over the driver tables together
with an independent SQL statement of each (the correctness oracle).
"""
