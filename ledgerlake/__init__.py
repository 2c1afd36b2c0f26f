"""ledgerlake -- a transaction lakehouse (bronze / silver / quarantine / gold)
expressed with Spark DataFrame and Structured Streaming operators.

The names most users need::

    from ledgerlake import build_session, LayerStore, run_batch, LOCAL, CLOUD
"""

__version__ = "0.1.0"

from ledgerlake.functions.rules import CLOUD, LOCAL, PROFILES, Profile, Rule  # noqa: E402
from ledgerlake.operators.bronze import bronze, encode_messages, raw_messages  # noqa: E402
from ledgerlake.operators.gold import add_risk, all_metrics, gold_metric  # noqa: E402
from ledgerlake.operators.monitor import monitoring_record  # noqa: E402
from ledgerlake.operators.quality import dedup, quarantine, silver, split, validate  # noqa: E402
from ledgerlake.plans.jobs import (  # noqa: E402
    LayerStore,
    gold,
    ingest,
    monitor_layers,
    quality,
    run_batch,
)
from ledgerlake.session import build_session, shared_dir  # noqa: E402

__all__ = [
    "CLOUD", "LOCAL", "PROFILES", "Profile", "Rule",
    "bronze", "encode_messages", "raw_messages",
    "add_risk", "all_metrics", "gold_metric", "monitoring_record",
    "dedup", "quarantine", "silver", "split", "validate",
    "LayerStore", "gold", "ingest", "monitor_layers", "quality", "run_batch",
    "build_session", "shared_dir",
]
