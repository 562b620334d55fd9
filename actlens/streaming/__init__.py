from actlens.streaming.incremental import (
    read_activity_stream, running_counts, running_profile, start, windowed_counts,
)

__all__ = ["read_activity_stream", "running_counts", "running_profile", "start", "windowed_counts"]
