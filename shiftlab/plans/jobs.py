"""The scheduled job: reports to documents, history and mail."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shiftlab.plans import reports as plan
from shiftlab.plans import documents, sinks


def publish(reports: DataFrame, out: str, run_id: str, shift_of: str = "first", whole: bool = True) -> DataFrame:
    """Store line reports, then write everything made from them below ``out``.

    Documents lie below ``out/documents`` at the paths that history names.
    ``whole=False`` writes them as ordered parts in folders instead and leaves out the mail,
    which carries whole documents. Returns the counts per site.
    """
    stored = sinks.write_line_reports(reports, f"{out}/line_reports", run_id)
    sinks.append_history(plan.report_history(stored, run_id, shift_of), f"{out}/history")
    if whole:
        sites = plan.site_reports(stored, shift_of)
        documents.write_at_paths(sites, f"{out}/documents", run_id)
        sinks.write_outbox(plan.outbox(sites), f"{out}/outbox", run_id)
    else:
        sinks.write_document_parts(plan.document_parts(stored, shift_of), f"{out}/documents")
    return plan.run_counts(stored)
