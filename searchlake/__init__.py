"""searchlake: search and faceted analytics over Parquet document tables, as Spark jobs.

Every operator is a plain function ``DataFrame -> DataFrame`` (or ``-> Column``);
nothing is evaluated until the caller runs an action, so Catalyst sees whole plans.
"""

from searchlake.session import get_session, scratch_dir, load_tables

__all__ = ["get_session", "scratch_dir", "load_tables"]
