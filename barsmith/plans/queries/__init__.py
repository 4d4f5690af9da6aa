"""Registered queries over the driver tables, with their DuckDB oracles.

Each query is ``(spark, sf_dir) -> DataFrame`` and runs one pipeline stage on
inputs derived from the whole given tables (see ``plans.driver_views``). Every
computed column has the same alias in Spark and in the oracle SQL. Modules are
imported in registration order.
"""

from barsmith.plans.queries import flagship  # noqa: F401
from barsmith.plans.queries import scalars  # noqa: F401
from barsmith.plans.queries import explode  # noqa: F401
from barsmith.plans.queries import manifests  # noqa: F401
from barsmith.plans.queries import resolution  # noqa: F401
from barsmith.plans.queries import store  # noqa: F401
from barsmith.plans.queries import sources  # noqa: F401
from barsmith.plans.queries import ingest_jobs  # noqa: F401
from barsmith.plans.queries import reports  # noqa: F401
from barsmith.plans.queries import commits  # noqa: F401
from barsmith.plans.queries import streams  # noqa: F401
from barsmith.plans.queries import splits  # noqa: F401
from barsmith.plans.queries import cells  # noqa: F401
from barsmith.plans.queries import symbols  # noqa: F401
from barsmith.plans.queries.common import ORACLE, QUERIES  # noqa: F401
