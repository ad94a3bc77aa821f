"""Registered queries: name -> (spark, source folder) -> DataFrame, over whole tables."""

from __future__ import annotations

from clientele.catalog import core, jobs, learning, profiles, reports

QUERIES = {**core.QUERIES, **jobs.QUERIES, **reports.QUERIES, **profiles.QUERIES, **learning.QUERIES}
