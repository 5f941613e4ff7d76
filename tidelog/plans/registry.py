"""All registered queries and their DuckDB SQL."""

from __future__ import annotations

from tidelog.plans import maintenance, relations, upload

QUERIES = {**upload.QUERIES, **relations.QUERIES, **maintenance.QUERIES}
ORACLE_SQL = {**upload.ORACLE_SQL, **relations.ORACLE_SQL, **maintenance.ORACLE_SQL}
