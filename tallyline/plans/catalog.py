"""All registered queries with the SQL that answers the same question."""

from __future__ import annotations

from tallyline.plans import commerce, content, metering, sessions, streams
from tallyline.plans.common import Query

_ALL = {
    name: entry
    for part in (metering, commerce, content, sessions, streams)
    for name, entry in part.QUERIES.items()
}

QUERIES: dict[str, Query] = {name: query for name, (query, _) in _ALL.items()}
SQL: dict[str, str] = {name: sql for name, (_, sql) in _ALL.items() if sql}
