"""All queries of the library outside its llm subpackage, and the SQL that must give the same rows."""

from __future__ import annotations

from . import accounts, core, marts, operations, resolution, silver, texts

QUERIES = core.QUERIES | texts.QUERIES | silver.QUERIES | resolution.QUERIES | accounts.QUERIES | marts.QUERIES | operations.QUERIES
ORACLE = core.ORACLE | texts.ORACLE | silver.ORACLE | resolution.ORACLE | accounts.ORACLE | marts.ORACLE | operations.ORACLE
