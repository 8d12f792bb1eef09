"""One weekly export run, end to end, as Spark jobs.

    resolve periods -> prune the fact to them -> star joins -> group and
    measure -> names and values -> files per period -> every sink (failures
    isolated) -> manifest

The one Catalyst plan covers every period of the run; there is no loop
over weeks and no pause between them.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekmart.plans import periods as P
from weekmart.plans.manifest import file_manifest, manifest
from weekmart.plans.summary import sales_available_periods, weekly_summary
from weekmart.sinks.files import ExportSpec, export_periods
from weekmart.sinks.ledger import load_periods, sink_status
from weekmart.sources.period_files import period_files


@dataclass
class RunResult:
    periods: DataFrame        # (year_num, week_num) chosen for the run
    result: DataFrame         # the summary in sink form
    manifest: DataFrame       # rows per chosen period (0 when empty)
    sinks: DataFrame | None   # (sink, status, rows, error)
    files: DataFrame | None   # per period and format: files, bytes, size
    ledger: DataFrame | None = None   # (run, sink, year_num, week_num, status, rows, error)


def run_weekly_export(spark: SparkSession, source: str, as_of: _dt.date,
                      *period_specs: P.PeriodSpec | None, category: str | None = None,
                      spec: ExportSpec | None = None) -> RunResult:
    """Run one export.  ``period_specs`` are in precedence order (command
    line, profile, configuration).  ``spec`` says which files to write and
    which sinks to load; without it nothing is written."""
    available = sales_available_periods(spark, source)
    wanted = P.resolve_periods(spark, as_of, available, *period_specs)
    result = weekly_summary(spark, source, periods=wanted, category=category)
    sinks = files = ledger = None
    if spec is not None:
        consumers = (1 if spec.root and spec.file_formats() else 0) + (1 if spec.sinks else 0)
        if consumers >= 1:
            # Files, sinks and the manifest all read the result: compute it
            # once, cut its lineage in the shared checkpoint folder.
            from weekmart.session import _checkpoint_root
            _checkpoint_root(spark)
            result = result.checkpoint(eager=True)
        written = export_periods(result, spec) if spec.root else {}
        if spec.sinks:
            ledger = load_periods(result, spec.sinks, wanted, spec.ledger, materialize=False)
            sinks = sink_status(ledger)
        parts = []
        for fmt in written:
            ext = "csv.gz" if fmt == "csv" and spec.compression == "gzip" else fmt
            parts.append(file_manifest(period_files(spark, f"{spec.root.rstrip('/')}/{fmt}", ext))
                         .withColumn("format", F.lit(fmt)))
        for p in parts:
            files = p if files is None else files.unionByName(p)
    return RunResult(periods=wanted, result=result, manifest=manifest(result, wanted),
                     sinks=sinks, files=files, ledger=ledger)
