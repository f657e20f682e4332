"""journeyloom: marketing-attribution analytics as Spark DataFrame plans.

Every operator takes and returns a Spark DataFrame of *touches* (one row per
marketing touch, see :mod:`journeyloom.schema`) or of something derived from it.
"""

__version__ = "0.1.0"
