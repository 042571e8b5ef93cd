"""cohortmart — clinical research marts on Spark DataFrames.

Entity–attribute–value (EAV) facts in an i2b2-style star schema are built
from wide batches (unpivot, surrogate ids, declarative mapping) and
flattened back to analysis tables (first visit, last visit, all visits,
MRI-near-diagnosis window), optionally with hashed identifiers.

Public entry points:

* :class:`cohortmart.schema.Mart` — the star tables of one mart.
* :func:`cohortmart.plans.export.export` — the four flattening strategies.
* :func:`cohortmart.plans.ingest.ingest_imaging` — wide imaging batch → star tables.
* :func:`cohortmart.operators.anonymize.anonymize_mart` — consistent id hashing.
"""

from cohortmart.schema import Mart  # noqa: F401

__all__ = ["Mart"]
