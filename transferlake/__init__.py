"""transferlake: money-transfer lake analytics as ordinary Spark DataFrame operators.

Layout
  functions/  column expressions (parsing, id normalisation, time conversion)
  sources/    landing CSV, JSON event payloads, test-table fixture views, lake tables
  operators/  cleaning/quarantine, enrichment, sliding stats, analytics, ordering, publishing
  streaming/  Structured Streaming jobs, replay-safe sinks, alerts
  plans/      named query builders and their SQL oracles, end-to-end jobs

The most used operators are re-exported here.
"""

__version__ = "0.1.0"

from transferlake.operators.analytics import (  # noqa: E402,F401
    large_transfer_alerts, large_usd, sender_avg_diff, sorted_transfers, status_counts,
    table_preview, top_users, transfers_view, unknown_status, user_currency_totals, user_totals,
    user_totals_all, user_totals_having)
from transferlake.operators.cleaning import (  # noqa: E402,F401
    clean_transfers, dedupe_transfers, dlq_rows, dlq_transfers, fill_missing_timestamp,
    good_rows, good_transfers, reference_routes, reject_summary, split_transfers, tag_transfers)
from transferlake.operators.enrich import (  # noqa: E402,F401
    enrich_events, receiver_dim, snapshot_dimension)
from transferlake.operators.ordering import (  # noqa: E402,F401
    lag_in_group, prev_amount_by_sender, running_number)
from transferlake.operators.publish import publish_events  # noqa: E402,F401
from transferlake.operators.stats import serving_layout, sliding_stats  # noqa: E402,F401
from transferlake.sources.events import decode_events, read_event_stream  # noqa: E402,F401
from transferlake.sources.landing import read_landing  # noqa: E402,F401
