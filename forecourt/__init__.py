"""forecourt: deal and reconditioning-cost analytics expressed as Spark DataFrame plans.

Layout
------
``sources``    table loaders, projection/rename helpers
``functions``  column expressions (time shift, buckets, labels) and rule tables
``operators``  relational building blocks (lookups, latest-per-key, pivots, fan-out sums,
               ranked de-duplication, repeat-deal detection, null-safe merge)
``plans``      the data products built from the operators, and the query catalog
``sinks``      snapshot publishing and text export
"""

from forecourt.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
