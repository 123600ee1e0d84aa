"""Query name -> callable ``(spark, sf_dir) -> DataFrame`` and oracle SQL."""

from __future__ import annotations

from tidewater.plans import dashboard, event_jobs, fold_jobs, relational, text_jobs
from tidewater.streaming import jobs as stream_jobs
from tidewater.streaming import source_jobs

QUERIES: dict = {}
ORACLE: dict = {}
for _mod in (text_jobs, event_jobs, dashboard, relational, fold_jobs, stream_jobs, source_jobs):
    QUERIES.update(_mod.QUERIES)
    ORACLE.update(_mod.ORACLE)
