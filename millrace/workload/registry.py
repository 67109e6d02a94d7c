"""All registered queries and their SQL twins."""

from __future__ import annotations

from millrace.workload import churn, files, logs, sales, streams, users

QUERIES = {**logs.QUERIES, **sales.QUERIES, **users.QUERIES, **churn.QUERIES, **streams.QUERIES, **files.QUERIES}
ORACLES = {**logs.ORACLES, **sales.ORACLES, **users.ORACLES, **churn.ORACLES, **streams.ORACLES, **files.ORACLES}

# the report of the streaming run is the report of the batch run
ORACLES["stream_report"] = ORACLES["sales_report"]

flagship = streams.detected_incidents
