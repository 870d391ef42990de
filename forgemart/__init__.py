"""Activity lakehouse on Spark: bronze, silver, star schema and analytic queries.

Every public function takes DataFrames and returns DataFrames; nothing is collected, and nothing but the
functions in ``sources`` and ``streaming`` touches storage.
"""

from forgemart.plans.star import Star
from forgemart.session import configure

__all__ = ["Star", "configure"]
