"""All registered queries and their SQL twins."""

from . import documents, evaluation, exploring, grounding, monitoring, responses, runs, storage, training
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
