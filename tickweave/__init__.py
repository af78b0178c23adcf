"""tickweave: many-series market time-series analytics on Spark DataFrames.

Every operator takes and returns DataFrames and handles all series at once.
Series are keyed by a column (``currency`` by default) and ordered by
``(dt, event_id)``; see ``tickweave.plans.sequence`` for how positions are
assigned without placing a whole series in one task.
"""

from tickweave.session import checkpoint_root, get_session

__all__ = ["get_session", "checkpoint_root"]
