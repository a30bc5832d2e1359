"""Report on the last batch: newest rows, enrichment, id reconciliation, yearly metrics."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tarnlake.operators.batches import latest_slice
from tarnlake.operators.enrich import enrich
from tarnlake.operators.history import latest_per_key
from tarnlake.operators.metrics import annual_metrics
from tarnlake.operators.sets import reconcile_ids
from tarnlake.schemas import METRIC_COLUMNS
from tarnlake.session import work_folder
from tarnlake.sources.tables import overwrite_batch, overwrite_table, read_table


@dataclass(frozen=True)
class Report:
    """The results as lazy DataFrames; ``over`` builds them anew from (samples, sites, methods).

    ``inputs`` are these three after slice and collapse, of which all results are made.
    """

    joined: DataFrame
    reconciliation: DataFrame
    metrics: DataFrame
    inputs: tuple[DataFrame, DataFrame, DataFrame]
    over: Callable[..., "Report"]


def _stored(df: DataFrame, label: str) -> DataFrame:
    folder = work_folder(df.sparkSession, label)
    df.write.mode("overwrite").parquet(folder)
    return read_table(df.sparkSession, folder, df.schema)


def build_report(
    samples: DataFrame,
    sites: DataFrame,
    methods: DataFrame,
    ledger: DataFrame | None = None,
    *,
    collapse_samples: bool = True,
    sample_keys: tuple[str, ...] = ("SITE_ID",),
    site_keys: tuple[str, ...] = ("SITE_ID", "PROGRAM_ID"),
    program_key: str = "PROGRAM_ID",
    sample_date: str = "DATE_SMP",
    site_date: str = "UPDATE_DATE",
    method_date: str = "END_YEAR",
    sample_tie_break: tuple[str, ...] = ("DATE_SMP",),
    site_tie_break: tuple[str, ...] = (),
    method_tie_break: tuple[str, ...] = (),
    measures: dict[str, str] = METRIC_COLUMNS,
    ties_are_unique: bool = False,
    spread: int | None = None,
) -> Report:
    """All three results as lazy DataFrames.

    With a ledger only samples in the last batch's date range take part. By default each
    site counts with its newest sample only; ``collapse_samples=False`` keeps all samples,
    and the metrics are then true yearly means. Sites and methods always count with their
    newest row, so a sample never multiplies.

    ``ties_are_unique`` declares that the tie-break columns tell rows of a key apart; what
    the metrics do not use is then not read. ``spread`` is that of ``enrich``; where each site
    has one sample left, no site is hot and none is searched for.
    """
    if ledger is not None:
        samples = latest_slice(samples, sample_date, ledger)
    if collapse_samples:
        if spread is None and set(sample_keys) <= set(site_keys):
            spread = 1
        samples = latest_per_key(samples, list(sample_keys), sample_date, list(sample_tie_break), ties_are_unique)
    sites = latest_per_key(sites, list(site_keys), site_date, list(site_tie_break), ties_are_unique)
    methods = latest_per_key(methods, [program_key], method_date, list(method_tie_break), ties_are_unique)

    def over(samples, sites, methods):
        joined = enrich(samples, sites, methods, site_keys, program_key, spread)
        missing = reconcile_ids(samples, sites, site_keys[0], left_name="samples", right_name="sites")
        metrics = annual_metrics(joined, f"{site_keys[0]}_LTM", f"{program_key}_LTM", sample_date, measures)
        return Report(joined, missing, metrics, (samples, sites, methods), over)

    return over(samples, sites, methods)


def save_report(
    report: Report,
    joined_folder: str,
    metrics_target: str,
    version_id: str,
    reconciliation_folder: str | None = None,
    **metric_options,
) -> DataFrame:
    """Store the joined rows under their version, then the metrics taken from them.

    The join runs once: the metrics read back the few columns they need, and saving a
    version again replaces it. With a folder for it, the reconciliation is stored whole under
    the same version. Join and reconciliation then share their inputs: the newest samples and
    sites are stored first, so that every table is read, sliced and collapsed once.
    """
    spark = report.joined.sparkSession
    if reconciliation_folder:
        samples, sites, methods = report.inputs
        report = report.over(_stored(samples, "report-samples"), _stored(sites, "report-sites"), methods)
    stored = overwrite_batch(report.joined, joined_folder, version_id, "version_id")
    metrics = annual_metrics(read_table(spark, stored, report.joined.schema), **metric_options)
    overwrite_table(metrics, metrics_target)
    if reconciliation_folder:
        overwrite_batch(report.reconciliation, reconciliation_folder, version_id, "version_id")
    return read_table(spark, metrics_target)
