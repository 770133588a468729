"""When a stream runs its micro-batches."""

from __future__ import annotations

# How often each continuous job runs a micro-batch.
JSON_EVENT_INTERVAL = "30 seconds"
TELEMETRY_INTERVAL = "1 minute"
WORD_INTERVAL = "5 minutes"
PUBLISH_INTERVAL = "1 second"


def trigger(every: str | None) -> dict[str, object]:
    """Trigger arguments: a micro-batch `every` interval, or None to drain the input and stop."""
    return {"availableNow": True} if every is None else {"processingTime": every}
