"""actlens: user-activity analytics (counts, peaks, funnels, session
sequences, anomaly rules) as Spark DataFrame operators."""

from actlens.operators.anomaly import (
    anomaly_report, anomaly_totals, behavior_report, flag_anomalies, flag_counts, flagged, hyperactive,
    label_hyperactive, profile, user_behavior, user_points, views_threshold, with_ratio,
)
from actlens.operators.explore import count_by, peak, top_users, totals, user_activity, with_share
from actlens.operators.funnel import (
    action_matrix, conversion, funnel_reach, funnel_stage, funnel_stage_summary, stacked_actions,
)
from actlens.operators.prepare import (
    add_calendar, cleaning_report, coverage, domains, drop_incomplete, filter_activity, parse_time,
    persist_prepared, prepare, preview, search_users, selection,
)
from actlens.operators.report import describe_all, schema_profile, summary
from actlens.operators.sequence import (
    complete_session_count, complete_sessions, session_events, session_position, session_rank, session_sequences,
)
from actlens.sources import activity, read_activity, write_csv

__all__ = [
    "anomaly_report", "anomaly_totals", "behavior_report", "flag_anomalies", "flag_counts", "flagged",
    "hyperactive", "label_hyperactive", "profile", "user_behavior", "user_points", "views_threshold",
    "with_ratio", "count_by", "peak", "top_users", "totals", "user_activity", "with_share",
    "action_matrix", "conversion", "funnel_reach", "funnel_stage", "funnel_stage_summary",
    "stacked_actions", "add_calendar", "cleaning_report", "coverage", "domains", "drop_incomplete",
    "filter_activity", "parse_time", "persist_prepared", "prepare", "preview", "search_users", "selection",
    "describe_all", "schema_profile", "summary", "complete_session_count", "complete_sessions",
    "session_events", "session_position", "session_rank", "session_sequences", "activity", "read_activity",
    "write_csv",
]
