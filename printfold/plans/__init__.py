from printfold.plans.audit import audit, audit_changes, compact_reports, read_report
from printfold.plans.ingest import ingest
from printfold.plans.publish import publish

__all__ = ["audit", "audit_changes", "compact_reports", "ingest", "publish", "read_report"]
