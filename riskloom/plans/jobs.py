"""The jobs end to end: ingest, train, publish, score a stream, open the dashboard."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.constants import PARTITION_COLUMNS
from riskloom.functions.dates import parse_raw_date, partition_parts
from riskloom.operators import learning, report
from riskloom.operators.cleaning import latest_reports, measure_fill, quarantine
from riskloom.session import materialize
from riskloom.sinks.files import write_partitioned
from riskloom.sinks.paths import check_output
from riskloom.sources.jdbc import JdbcTable, read_predictions
from riskloom.sources.reports import UNREADABLE, read_reports, read_reports_csv
from riskloom.streaming.once import without_copies
from riskloom.streaming.scoring import fault_counts, judged_messages, score_reports
from riskloom.streaming.sinks import BatchWriter, start_batches

LOG = logging.getLogger("riskloom")

Source = DataFrame | Callable[[], DataFrame]


@dataclass(frozen=True)
class IngestReport:
    """Rows read and written, and what was found on the way."""

    rows: int
    written_rows: int
    columns: int
    dropped_columns: list[str]
    unparsed_dates: int
    unreadable_lines: int = 0
    quarantined_rows: int = 0


def ingest(
    spark: SparkSession,
    csv_paths: str | list[str],
    output_path: str,
    min_fill: float = 0.5,
    keys: Sequence[str] = tuple(PARTITION_COLUMNS),
    touched_only: bool = False,
    quarantine_path: str | None = None,
    latest: bool = False,
) -> IngestReport:
    """Raw CSV to partitioned Parquet in two jobs.

    The first reads the files once for everything the report and the choice of columns need.
    The second writes, and counts what it writes. Dates that cannot be read are kept as null
    and counted, and so are lines that do not fit the schema. Fewer keys, such as year and
    month, give fewer and larger files; the other parts stay columns.

    With a quarantine_path unusable reports go there, with the reason, instead. With latest
    one report per state, county and date is kept, which needs the unusable ones gone.
    """
    inputs = [csv_paths] if isinstance(csv_paths, str) else list(csv_paths)
    for path in filter(None, (output_path, quarantine_path)):
        check_output(path, inputs)
    if latest and not quarantine_path:
        raise ValueError("latest reports need a quarantine_path for the unusable ones")
    raw = read_reports_csv(spark, inputs, keep_unreadable=True)
    date = parse_raw_date(F.col("date"))
    fill = measure_fill(
        raw,
        unparsed_dates=F.col("date").isNotNull() & date.isNull(),
        unreadable=F.col(UNREADABLE).isNotNull(),
    )
    dropped = fill.sparse_columns(min_fill, keep=["date", UNREADABLE])
    dated = raw.drop(*dropped, UNREADABLE).withColumn("date", date)
    quarantined = 0
    if quarantine_path:
        dated, bad = quarantine(dated)
        quarantined = _counted_write(bad, lambda df: df.write.mode("overwrite").parquet(quarantine_path))
        if latest:
            dated = latest_reports(dated).drop("copies")
    curated = dated.withColumns(partition_parts(F.col("date")))
    written = _counted_write(
        curated, lambda df: write_partitioned(df, output_path, keys, inputs, touched_only)
    )
    return IngestReport(
        fill.rows,
        written,
        len(curated.columns),
        dropped,
        fill.extra["unparsed_dates"],
        fill.extra["unreadable"],
        quarantined,
    )


def _counted_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Rows that a write wrote, counted by the write itself."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


@dataclass(frozen=True)
class Training:
    model: PipelineModel
    held_out: DataFrame

    def quality(self) -> DataFrame:
        return learning.evaluate(learning.predict(self.model, self.held_out))


def train_on(
    reports: DataFrame, kind: str = "forest", weighted: bool | None = None, **params
) -> Training:
    """Fit on the training share of the reports; the held-out rows remain for evaluation.

    Rows are prepared once and written to the shared folder, both sides; weighted ones once more
    after identical feature rows have become one. A forest is fitted to plain rows unless asked
    otherwise.
    """
    if weighted is None:
        weighted = learning.weighted_by_default(kind)
    chosen, held_out = learning.written_split(learning.training_rows(reports))
    if weighted:
        rows = materialize(learning.compact(chosen), "training")
    else:
        rows = chosen.select(*learning.TRAINING_COLUMNS)
    return Training(learning.train(rows, kind, **params), held_out)


@dataclass(frozen=True)
class Candidate:
    """A kind of classifier with its parameters."""

    kind: str
    params: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Selection:
    """Accuracy of every candidate in every fold, the one that is best on the mean, and the rows of
    all folds.

    None stands for a fold without whose rows a candidate cannot be fitted (learning.fits);
    such a candidate has no mean and is not chosen.
    """

    accuracy: dict[str, list[float | None]]
    best: str
    rows: int

    def mean(self, name: str) -> float | None:
        return _mean(self.accuracy[name])

    def scores(self, spark: SparkSession) -> DataFrame:
        """candidate, fold, accuracy."""
        rows = [(n, i, a) for n, found in self.accuracy.items() for i, a in enumerate(found)]
        return spark.createDataFrame(rows, "candidate STRING, fold INT, accuracy DOUBLE")


def _mean(found: list[float | None]) -> float | None:
    return None if not found or None in found else sum(found) / len(found)


def select_model(
    reports: DataFrame, candidates: dict[str, Candidate], folds: int = 3
) -> Selection:
    """Repeated validation: each candidate is fitted once per fold, without it, and judged on it.

    Only the training share takes part, so the held-out reports can still judge the winner. The
    share is written once, as plain rows for forests, and from those as weighted ones for the others
    and for judging, in both cases with the fold; a fold is a filter of that table. One aggregate counts
    the hits of a fold, by weight. A fold without a row says nothing and is left out. Of equal
    means the first candidate wins.
    """
    chosen, _ = learning.split(learning.training_rows(reports))
    numbered = learning.with_fold(chosen, folds)
    fold, label = F.col(learning.FOLD_COLUMN), F.col(learning.LABEL_COLUMN).cast("int")
    plain = numbered.select(*learning.TRAINING_COLUMNS, fold)
    tables = {}
    if not all(learning.weighted_by_default(c.kind) for c in candidates.values()):
        tables[False] = plain = materialize(plain, "folds-plain")
    tables[True] = weighted = materialize(learning.compact(plain), "folds-weighted")
    weight = F.sum(learning.WEIGHT_COLUMN).alias("n")
    counts = weighted.groupBy(fold.alias("fold"), label.alias("label")).agg(weight).collect()
    sizes = {i: sum(r.n for r in counts if r.fold == i) for i in sorted({r.fold for r in counts})}
    accuracy: dict[str, list[float | None]] = {}
    for name, candidate in candidates.items():
        rows = tables[learning.weighted_by_default(candidate.kind)]
        accuracy[name] = []
        for i, size in sizes.items():
            if not learning.fits(candidate.kind, {r.label for r in counts if r.fold != i}):
                accuracy[name].append(None)
                continue
            model = learning.train(rows.where(fold != i), candidate.kind, **candidate.params)
            judged = learning.predict(model, weighted.where(fold == i))
            hit = label == F.col("predicted_risk_category")
            hits = judged.where(hit).agg(weight).first().n
            accuracy[name].append((hits or 0.0) / size)
        LOG.info("%s: accuracy by fold %s", name, accuracy[name])
    means = {n: _mean(found) for n, found in accuracy.items()}
    able = [n for n in means if means[n] is not None]
    if not able:
        raise ValueError("no candidate can be fitted to every part of these reports")
    return Selection(accuracy, max(able, key=lambda n: means[n]), int(sum(sizes.values())))


def train(
    spark: SparkSession,
    reports_path: str,
    model_path: str,
    year: int | None = None,
    kind: str = "forest",
    **params,
) -> Training:
    """Fit on curated reports and save the model."""
    training = train_on(read_reports(spark, reports_path, year), kind, **params)
    learning.save(training.model, model_path)
    return training


def score_stream(
    messages: DataFrame,
    model: PipelineModel,
    write_batch: BatchWriter,
    checkpoint: str,
    available_now: bool = False,
    interval: str | None = None,
    rejected: BatchWriter | None = None,
    on_counts: Callable[[int, dict[str, int]], None] | None = None,
    once: str | None = None,
) -> StreamingQuery:
    """Messages to predictions to a sink; the model is loaded once, before the stream starts.

    The model is applied to each micro-batch as a plain table, which every kind of model
    allows. What a batch drops is counted while it is written, by kind of fault, and handed to
    on_counts, by default the log; with rejected the messages themselves are kept as well.
    With once, a lateness such as "30 days", reports sent again are left out (without_copies).
    """
    if once is not None:
        messages = without_copies(messages, once)
    tell = on_counts or (lambda batch_id, counts: LOG.info("batch %s: %s", batch_id, counts))

    def write(batch: DataFrame, batch_id: int, stream: str) -> bool:
        judged = judged_messages(batch)
        if rejected is not None:
            bad = judged.where(F.col("fault").isNotNull()).select("value", "fault")
            rejected(bad, batch_id, stream)
        seen = Observation()
        reports = judged.observe(seen, *fault_counts()).drop("value", "fault")
        scored = score_reports(reports, lambda rows: learning.predict(model, rows))
        wrote = write_batch(scored, batch_id, stream)
        if wrote:
            tell(batch_id, seen.get)
        return wrote

    return start_batches(
        messages.select("value"),
        write,
        checkpoint,
        available_now,
        interval,
        large_state=once is not None,
    )


@dataclass(frozen=True)
class Dashboard:
    """Predictions with labels and codes, and their small summary kept in memory.

    Counts and means come from the summary; tables and exports come from the predictions.
    """

    predictions: DataFrame
    summary: DataFrame
    source: Source
    codes: DataFrame | None = None
    kept_summary: Callable[[], DataFrame] | None = None

    def category_distribution(self) -> DataFrame:
        return report.category_distribution(self.summary)

    def actual_vs_predicted(self) -> DataFrame:
        return report.actual_vs_predicted(self.summary)

    def risk_over_time(self) -> DataFrame:
        return report.risk_over_time(self.summary)

    def mean_risk_by_state(self, with_codes: bool = True) -> DataFrame:
        return report.mean_risk_by_state(self.summary, with_codes=with_codes)

    def top_high_risk_states(self, k: int = 10, distinct: bool = False) -> DataFrame:
        rows = self.predictions if distinct else self.summary
        return report.top_high_risk_states(rows, k, distinct)

    def filter_options(self) -> DataFrame:
        return report.filter_options(self.summary)

    def state_options(self) -> DataFrame:
        return report.distinct_values(self.summary, "state")

    def risk_options(self) -> DataFrame:
        return report.risk_options(self.summary)

    def details_count(self, **filters) -> DataFrame:
        return report.filtered_count(self.summary, **filters)

    def details(self, **filters) -> DataFrame:
        return report.display_view(report.filter_predictions(self.predictions, **filters))

    def high_risk_table(self) -> DataFrame:
        return report.high_risk_table(self.predictions)

    def available(self) -> set[str]:
        """The questions that the columns at hand allow."""
        return report.available(self.predictions)

    def is_empty(self) -> bool:
        return self.summary.isEmpty()

    def close(self) -> None:
        self.summary.unpersist()

    def refresh(self) -> Dashboard:
        """Close this one and open the same source again, with what it holds by now."""
        self.close()
        return open_dashboard(self.source, self.codes, self.kept_summary)


def open_dashboard(
    source: Source,
    codes: DataFrame | None = None,
    kept_summary: Callable[[], DataFrame] | None = None,
) -> Dashboard:
    """A dashboard on predictions, or on what a function reads each time it is opened.

    Counting all predictions again is left out where a stream keeps their summary up to date:
    kept_summary then reads it (streaming.summary.read_summary).
    """
    predictions = source() if callable(source) else source
    enriched = report.enrich_predictions(predictions, codes)
    summary = kept_summary() if kept_summary else report.summarise(predictions, codes)
    return Dashboard(
        enriched, summary.persist(StorageLevel.MEMORY_AND_DISK), source, codes, kept_summary
    )


def open_jdbc_dashboard(
    spark: SparkSession, table: JdbcTable, codes: DataFrame | None = None
) -> Dashboard:
    return open_dashboard(lambda: read_predictions(spark, table), codes)
