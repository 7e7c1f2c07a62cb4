"""Arguments shared by the registered queries and their SQL."""

from __future__ import annotations

from tidemark.config import TABLES, RunContext

AS_OF = "2024-01-31 20:00:00"
RUN_ID = "run00001"
ENVIRONMENT = "development"
PIPELINE = "tidemark"
CONTEXT = RunContext(run_id=RUN_ID, as_of=AS_OF, environment=ENVIRONMENT, pipeline_name=PIPELINE)

# Minimum rows divided by this, so that small test tables show both outcomes.
SCALED_DOWN = 8
STATUS_TABLES = tuple(TABLES)
