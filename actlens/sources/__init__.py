from actlens.sources.csv import read_activity, write_csv
from actlens.sources.events import activity, activity_from_events, gap_sessions, user_totals
from actlens.sources.schema import ACTIVITY_COLUMNS, RAW_ACTIVITY
from actlens.sources.scratch import materialize, scratch_path
from actlens.sources.store import read_prepared, save_prepared
from actlens.sources.tables import table

__all__ = [
    "read_activity", "write_csv", "activity", "activity_from_events", "gap_sessions",
    "user_totals", "ACTIVITY_COLUMNS", "RAW_ACTIVITY", "materialize", "scratch_path", "table",
    "read_prepared", "save_prepared",
]
