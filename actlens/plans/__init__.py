from actlens.plans.catalog import QUERIES
from actlens.plans.oracle import oracle_sql
from actlens.plans.session import build_session

__all__ = ["QUERIES", "oracle_sql", "build_session"]
