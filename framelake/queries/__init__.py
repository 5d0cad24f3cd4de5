"""Queries over the driver's tables, one or more for each operator, and the SQL that must give the same rows."""

from __future__ import annotations

from framelake.queries import editing, images, joins, keypoints, labelling, models, more, sampling, series, statistics, streams
from framelake.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "editing", "images", "joins", "keypoints", "labelling", "models", "more", "sampling", "series", "statistics", "streams"]
