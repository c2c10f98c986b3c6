"""relaylens: message-delivery report analytics on Spark.

Public entry points (DataFrame in, DataFrame out unless noted):

* sources: ``read_reports`` (CSV inbox -> raw rows), ``messages`` and
  ``event_messages`` (rows from the driver tables), JDBC helpers in
  ``relaylens.sources.jdbc``;
* operators: ``normalize_detail``, ``daily_summary``, ``daily_stats``,
  ``low_rate_alerts``, ``render_alerts``, ``audit_row``;
* plans: ``run_load`` (one complete load), ``backfill``;
* streaming: ``start_load_stream``.
"""

from relaylens.operators.alerts import alert_rates, low_rate_alerts, render_alerts
from relaylens.operators.audit import audit_row, recent_loads
from relaylens.operators.detail import conform_to_contract, normalize_detail, project_to_target
from relaylens.operators.summary import daily_stats, daily_summary, daily_summary_two_branch
from relaylens.plans.backfill import backfill
from relaylens.plans.load import LoadConfig, Warehouse, run_load
from relaylens.session import build_session
from relaylens.sources.events import event_messages
from relaylens.sources.messages import messages
from relaylens.sources.reports import read_report_paths, read_reports
from relaylens.streaming.ingest import start_load_stream

__all__ = [
    "LoadConfig",
    "Warehouse",
    "alert_rates",
    "audit_row",
    "backfill",
    "build_session",
    "conform_to_contract",
    "daily_stats",
    "daily_summary",
    "daily_summary_two_branch",
    "event_messages",
    "low_rate_alerts",
    "messages",
    "normalize_detail",
    "project_to_target",
    "read_report_paths",
    "read_reports",
    "recent_loads",
    "render_alerts",
    "run_load",
    "start_load_stream",
]
