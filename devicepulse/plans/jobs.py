"""The five batch jobs.

Each reads what the one before it wrote. Stage tables are Parquet in the output folder (or CSV, on
request), so a later step reads only the columns it needs and a lost executor costs no earlier
stage. Only profile rows (one number per column) and schemas reach the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicepulse.functions import null_sentinels
from devicepulse.operators import cleaning, cycles, dedup, joins, model, ranking, scaling, splitting, tails
from devicepulse.sources import (
    Buckets,
    commit_table,
    current_version,
    load_classifier,
    load_manifest,
    pin,
    read_current,
    read_table,
    read_version,
    save_artefact,
    save_manifest,
    without_target,
    write_scores,
)
from devicepulse.spec import DEVICE_HASH, TelemetrySpec


@dataclass(frozen=True)
class Layout:
    """Where a run keeps its tables and artefacts.

    Tables are versions (see `sources.versions`): a job that stops halfway leaves each table as it was, with its
    types. With `buckets`, stage tables that have the device's hash are laid out by it in so many parts, and the
    joins and windows of later jobs need no shuffle. Give as many as a shuffle would have partitions.
    """

    root: str
    fmt: str = "parquet"
    buckets: int | None = None

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/tables/{name}"

    def artefact(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/artefacts/{name}"

    def manifest(self, name: str) -> str:
        return self.artefact(f"{name}_columns")

    def schema(self, spark: SparkSession, name: str) -> T.StructType:
        """The types of a stage table, without the column that it is laid out by."""
        version = current_version(spark, self.table(name))
        if version is None:
            raise FileNotFoundError(f"no table {name} in {self.root}")
        return T.StructType([f for f in version.schema.fields if f.name != DEVICE_HASH])

    def read(self, spark: SparkSession, name: str, laid_out: bool = False) -> DataFrame:
        """A stage table; with `laid_out` including the column that it may be laid out by."""
        rows = read_current(spark, self.table(name))
        return rows if laid_out else rows.drop(DEVICE_HASH)

    def write(
        self,
        df: DataFrame,
        name: str,
        mode: str,
        partition_by: Sequence[str] = (),
        spec: TelemetrySpec | None = None,
        placed: bool = False,
    ) -> None:
        """Commit a version. Tables with the device's hash are laid out by it where `buckets` is given, ordered
        by the day key of `spec`; `placed` says that they come from such tables."""
        buckets = None
        if self.buckets and spec and DEVICE_HASH in df.columns:
            buckets = Buckets((DEVICE_HASH,), self.buckets, tuple(spec.hashed().day_key))
        commit_table(df, self.table(name), self.fmt, mode, partition_by, buckets, placed)


def report_counts(layout: Layout, name: str, counts: dict[str, int]) -> None:
    """Write a record of counts next to the artefacts."""
    row = SparkSession.active().range(1)
    report = row.select(*[F.lit(n).cast("bigint").alias(c) for c, n in counts.items()])
    write_scores(report, layout.artefact(name))


def report_rows(layout: Layout, name: str, rows: int, kept: int) -> None:
    """How many rows a null drop took. The counts come from tables already written."""
    report_counts(layout, name, {"rows": rows, "kept": kept, "dropped": rows - kept})


def clean_readings(df: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """Null out missing-value markers in all columns but the device and date: a device that is called `NA`
    is still a device."""
    fields = {f.name: f for f in df.schema.fields}
    return df.select(
        *[F.col(f"`{c}`") if c in spec.day_key else null_sentinels(fields[c]) for c in df.columns]
    )


def number_types(df: DataFrame, columns: Sequence[str]) -> tuple[dict[str, str], dict[str, int]]:
    """What the text columns hold, in one pass: a number type for those that hold nothing else (`bigint`
    where every number is whole and small enough, else `double`), and for the others how many cells are no
    number. A column without any value counts as double. One row reaches the driver.
    """
    if not columns:
        return {}, {}
    counts = []
    for i, c in enumerate(columns):
        cell = F.col(f"`{c}`")
        known = cell.isNotNull()
        counts.append(F.count_if(known).alias(f"known_{i}"))
        counts.append(F.count_if(known & cell.try_cast("double").isNull()).alias(f"other_{i}"))
        # A text that says the number in another way, `1e3` or `1.0`, is left to double.
        whole = cell.rlike(r"^\s*[+-]?[0-9]+\s*$") & cell.try_cast("bigint").isNotNull()
        counts.append(F.count_if(known & ~whole).alias(f"broken_{i}"))
    row = df.agg(*counts).first()
    types, others = {}, {}
    for i, c in enumerate(columns):
        if row[f"other_{i}"]:
            others[c] = row[f"other_{i}"]
        else:
            types[c] = "bigint" if row[f"known_{i}"] and not row[f"broken_{i}"] else "double"
    return types, others


def drop_duplicates_job(
    spark: SparkSession,
    source: str,
    layout: Layout,
    spec: TelemetrySpec,
    fmt: str = "csv",
    schema: T.StructType | None = None,
    order: Sequence[str | Column] | None = None,
    mostly_unique: bool = False,
    mode: str = "errorifexists",
) -> DataFrame:
    """One row per device-day. `mostly_unique` spares a wide table with few repeats its shuffle."""
    rows = dedup.one_row_per_day(read_table(spark, source, fmt, schema), spec, order, mostly_unique)
    rows = spec.with_device_hash(rows) if layout.buckets else rows
    layout.write(rows, "deduplicated", mode, spec=spec)
    return layout.read(spark, "deduplicated")


def preprocess_job(
    spark: SparkSession,
    layout: Layout,
    spec: TelemetrySpec,
    number_cycles: bool = False,
    mode: str = "overwrite",
) -> DataFrame:
    """Cleaned table, cycle tables and training table.

    Cycles are found on the key columns alone. Failed cycles hold few of all rows, so the wide
    table is not shuffled to find them: it is joined with their device-days, and only what is left
    is laid out by device for the lags. Where stage tables are laid out by device, nothing is shuffled but
    profiles and, if asked for, the numbers of cycles.
    """
    deduplicated, plain = layout.read(spark, "deduplicated", laid_out=True), spec
    spec = spec.hashed() if DEVICE_HASH in deduplicated.columns else spec
    by_device = {"spec": plain, "placed": True}
    raw = clean_readings(deduplicated, spec)
    # A text column that holds only numbers is one whose file also held markers. Any other stays text: it is
    # no feature, and what kept it from being one is reported.
    texts = [
        f.name
        for f in raw.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in spec.reserved
    ]
    types, others = number_types(raw, texts)
    report_counts(layout, "unparsed_cells", {"text_columns": len(others), **others})
    for kind in ("bigint", "double"):
        raw = cleaning.restore_numbers(raw, [c for c, k in types.items() if k == kind], kind)
    numbers = clean_readings(raw, spec)
    sparse = cleaning.sparse_columns(numbers, spec)
    layout.write(cleaning.drop_columns(numbers, sparse), "cleaned", mode, **by_device)
    cleaned = layout.read(spark, "cleaned", laid_out=True)

    keyed = cleaned.select(*spec.day_key, spec.target_col)
    flagged = cycles.with_failed_flag(cycles.with_cycles(keyed, spec), spec).drop(spec.target_col)
    layout.write(flagged, "cycle_rows", mode, **by_device)
    cycle_rows = layout.read(spark, "cycle_rows", laid_out=True)
    if number_cycles:
        # Numbers follow the device columns, not their hash, and come by a join on those.
        layout.write(cycles.number_cycles(cycle_rows, plain), "cycle", mode, spec=plain)
        cycle_rows = layout.read(spark, "cycle", laid_out=True)
    layout.write(cycle_rows.where("cycle_failed").drop("cycle_failed"), "failed_cycle", mode, **by_device)

    failed = joins.with_cycle_columns(cleaned, layout.read(spark, "failed_cycle", laid_out=True), spec)
    layout.write(failed, "failed_rows", mode, **by_device)
    failed = layout.read(spark, "failed_rows", laid_out=True)
    constant = cleaning.constant_columns(failed, spec)
    varied = cleaning.drop_columns(failed, constant)
    lagged = cycles.lag_features(varied, spec, no_lag_cols=[*spec.reserved, *_texts(varied)])
    layout.write(cleaning.drop_incomplete(lagged).drop(DEVICE_HASH), "training", mode)
    training = layout.read(spark, "training")
    report_rows(layout, "training_rows", failed.count(), training.count())
    return training


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def feature_job(
    spark: SparkSession,
    layout: Layout,
    spec: TelemetrySpec,
    exact: bool = False,
    bucket: Column | None = None,
    buckets: int = splitting.BUCKETS,
    mode: str = "overwrite",
) -> splitting.Splits:
    """Scaled train, validation and test sets.

    The quartile ranges of train come from a sketch, or with `exact` are exact. Either way they are saved as
    one table of factors, under a new number that the model is trained with, so scoring cannot take those
    of another run. Rows of the other sets that scaling left incomplete are dropped and counted: the
    columns are chosen so that train has none. The three sets are the partitions of one table, so that one
    pass writes them all.
    """
    training = layout.read(spark, "training")
    features = spec.numeric_feature_cols(training)
    named = splitting.with_split(training, spec, bucket=bucket, buckets=buckets)
    keep, train = [spec.target_col, "split"], named.where(F.col("split") == "train")
    factors = scaling.exact_factors(train, features) if exact else scaling.fitted_factors(train, features)
    save_factors(spark, layout, factors, mode)
    scaled = scaling.scale_by_factors(named, factors, keep)
    save_manifest(training.select(*features), layout.manifest("num_feature"))
    cleaned = cleaning.parse_sentinels(scaled)
    sparse = cleaning.sparse_columns(cleaned.where(F.col("split") == "train"), spec, cutoff=0.0)
    final = cleaned.select(*[c for c in cleaned.columns if c not in [*sparse, "split"]], "split")
    counts = Observation("scaled")
    broken = {f"dropped_{s}": F.count_if((F.col("split") == s) & _incomplete(final)) for s in splitting.Splits._fields}
    seen = {f"rows_{s}": F.count_if(F.col("split") == s) for s in splitting.Splits._fields}
    observed = final.observe(counts, *[x.alias(c) for c, x in {**seen, **broken}.items()])
    layout.write(cleaning.drop_incomplete(observed), "scaled", mode, partition_by=["split"])
    report_counts(layout, "scaled_rows", counts.get)
    return read_splits(spark, layout)


def _incomplete(df: DataFrame) -> Column:
    found = F.lit(False)
    for c in df.columns:
        found = found | F.col(f"`{c}`").isNull()
    return found


def save_factors(spark: SparkSession, layout: Layout, factors: dict[str, float], mode: str) -> None:
    """The factor of each feature in order, with the number of this fit."""
    fit = uuid.uuid4().hex
    lines = [
        F.struct(
            F.lit(fit).alias("fit"),
            F.lit(i).alias("position"),
            F.lit(c).alias("column_name"),
            F.lit(float(x)).alias("factor"),
        )
        for i, (c, x) in enumerate(factors.items())
    ]
    table = spark.range(1).coalesce(1).select(F.inline(F.array(*lines)))
    commit_table(table, layout.artefact("factors"), mode=mode)


def load_factors(spark: SparkSession, layout: Layout) -> tuple[str, dict[str, float]]:
    """The number of the fit, and the factors. One row per feature reaches the driver."""
    rows = read_current(spark, layout.artefact("factors")).orderBy("position").collect()
    return rows[0].fit, {r.column_name: r.factor for r in rows}


def read_splits(spark: SparkSession, layout: Layout) -> splitting.Splits:
    scaled = layout.read(spark, "scaled")
    return splitting.Splits(
        *[scaled.where(F.col("split") == s).drop("split") for s in splitting.Splits._fields]
    )


def train_job(spark: SparkSession, layout: Layout, spec: TelemetrySpec, **params) -> DataFrame:
    """Fit and save the model, score it on the three sets, save the scores."""
    splits = read_splits(spark, layout)
    features = spec.feature_cols(splits.train)
    vectors = splits.map(lambda part: scaling.assemble(part, features, [spec.target_col]))
    fitted = model.fit_classifier(vectors.train, spec, **params)
    save_artefact(fitted, layout.artefact("model"))
    fit, _ = load_factors(spark, layout)
    write_scores(spark.range(1).select(F.lit(fit).alias("fit")), layout.artefact("model_fit"))
    save_manifest(splits.train.select(*features), layout.manifest("feature"))
    scores = model.score_splits(vectors.map(lambda part: model.predict(fitted, part)), spec)
    write_scores(scores, layout.artefact("model_scores"))
    return spark.read.schema(scores.schema).json(layout.artefact("model_scores"))


@dataclass(frozen=True)
class ScoringKit:
    """All that scoring needs from training."""

    preprocessed: T.StructType
    lagged: T.StructType
    num_features: T.StructType
    features: T.StructType
    factors: dict[str, float]
    classifier: GBTClassificationModel

    @classmethod
    def load(cls, spark: SparkSession, layout: Layout, spec: TelemetrySpec) -> ScoringKit:
        def stage(name: str) -> T.StructType:
            return without_target(layout.schema(spark, name), spec.target_col)

        def columns(name: str) -> T.StructType:
            return without_target(load_manifest(spark, layout.manifest(name)), spec.target_col)

        fit, factors = load_factors(spark, layout)
        trained_with = spark.read.json(layout.artefact("model_fit")).first().fit
        if fit != trained_with:
            raise ValueError("the model was trained with other scaling factors: run the train job again")
        return cls(
            stage("cleaned"),
            stage("training"),
            columns("num_feature"),
            columns("feature"),
            factors,
            load_classifier(layout.artefact("model")),
        )


def scoring_rows(
    rows: DataFrame, kit: ScoringKit, spec: TelemetrySpec, unique_days: bool = False
) -> DataFrame:
    """New rows laid out as the training table: cleaned, one per device-day, with cycles and lags.

    Cycles are added in place, so that cycles and lags share one shuffle by device. `unique_days`
    says that device-days are unique already, which saves the other one.
    """
    aligned = _aligned(rows, kit, spec, unique_days)
    lagged = cycles.lag_features(
        cycles.with_cycles(aligned, spec), spec, no_lag_cols=[*spec.reserved, *_texts(aligned)]
    )
    return lagged.select(*_lagged_names(kit, spec))


def _aligned(rows: DataFrame, kit: ScoringKit, spec: TelemetrySpec, unique_days: bool) -> DataFrame:
    """Cleaned rows with the columns and types of training, one per device-day."""
    one = rows if unique_days else dedup.one_row_per_day(rows, spec)
    return clean_readings(cleaning.select_as(clean_readings(one, spec), kit.preprocessed), spec)


def _lagged_names(kit: ScoringKit, spec: TelemetrySpec) -> list[str]:
    return [c for c in kit.lagged.names if c not in spec.cycle_cols]


def score_rows(
    rows: DataFrame, kit: ScoringKit, spec: TelemetrySpec, unique_days: bool = False
) -> DataFrame:
    """Predictions with device and date. Rows without a full set of lags cannot be scored."""
    return _scored(rows, kit, spec, unique_days, None, None)


def _counted(df: DataFrame, by: Observation | None) -> DataFrame:
    return df if by is None else df.observe(by, F.count(F.lit(1)).alias("rows"))


def _scored(
    rows: DataFrame,
    kit: ScoringKit,
    spec: TelemetrySpec,
    unique_days: bool,
    days: Observation | None,
    lagged: Observation | None,
) -> DataFrame:
    """Score, and count device-days and rows with all lags on the way where asked to."""
    return _predicted(_counted(scoring_rows(rows, kit, spec, unique_days), days), kit, spec, lagged)


def _predicted(rows: DataFrame, kit: ScoringKit, spec: TelemetrySpec, lagged: Observation | None = None) -> DataFrame:
    """Predictions for rows laid out as the training table."""
    complete = cleaning.drop_incomplete(rows)
    keep = spec.day_key
    factors = {c: kit.factors[c] for c in kit.num_features.names}
    scaled = scaling.scale_by_factors(_counted(complete, lagged), factors, keep)
    usable = cleaning.drop_incomplete(
        clean_readings(cleaning.select_as(scaled, [*keep, *kit.features.names]), spec), kit.features.names
    )
    return model.predict(kit.classifier, scaling.assemble(usable, kit.features.names, keep))


def inference_job(
    spark: SparkSession,
    layout: Layout,
    spec: TelemetrySpec,
    source: str | None = None,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    nrows: int | None = None,
    mode: str = "overwrite",
) -> DataFrame:
    """Score new rows (default: the cleaned table) with the saved artefacts.

    `nrows` keeps the first device-days in key order, as a trial run does; by default all are scored. A
    CSV source without a schema is read as text and takes its types from the manifest of training, so it
    is read once and `007` stays what it is. How many device-days got no prediction, for want of lags or
    because scaling left them incomplete, is counted while scoring and reported next to the artefacts.
    """
    if source is None:
        rows = layout.read(spark, "cleaned")
    elif fmt == "csv" and schema is None:
        types = {f.name: f.dataType for f in layout.schema(spark, "cleaned")}
        texts = spark.read.option("header", True).csv(source)
        rows = texts.select(
            *[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in texts.columns]
        )
    else:
        rows = read_table(spark, source, fmt, schema)
    if source is not None:
        rows = dedup.one_row_per_day(rows, spec)
    if nrows is not None:
        rows = ranking.first_rows(rows, spec.day_key, nrows)
    days, lagged = Observation("days"), Observation("lagged")
    predictions = _scored(rows, ScoringKit.load(spark, layout, spec), spec, True, days, lagged)
    # Vectors have no CSV form, so predictions are Parquet whatever the other tables are.
    commit_table(predictions, layout.table("predictions"), mode=mode)
    written = read_current(spark, layout.table("predictions"))
    n, full, kept = days.get["rows"], lagged.get["rows"], written.count()
    counts = {"rows": n, "kept": kept, "dropped": n - kept, "without_lags": n - full, "after_scaling": full - kept}
    report_counts(layout, "scored_rows", counts)
    return written



def new_days_job(
    spark: SparkSession,
    layout: Layout,
    spec: TelemetrySpec,
    rows: DataFrame,
    part: str,
    mode: str = "errorifexists",
) -> DataFrame:
    """Score the newest days of known and new devices by what is stored of each device's last days.

    `rows` are days after all that were scored so before, and `part` names them. Their cycles and lags are the
    ones that the whole history would give. Predictions are committed before the tails, so a job that
    stops in between is run once more for the same part with `mode="overwrite"`.
    """
    kit = ScoringKit.load(spark, layout, spec)
    version = current_version(spark, layout.table("tails"))
    aligned = _aligned(rows, kit, spec, False)
    tail = read_version(spark, version) if version else None
    found = pin(tails.continued(tail, aligned, spec))
    lagged = tails.new_rows_with_lags(found, spec, [*spec.reserved, *_texts(aligned)])
    predictions = _predicted(lagged.select(*_lagged_names(kit, spec)), kit, spec)
    commit_table(predictions, layout.table(f"new_predictions/{part}"), mode=mode)
    commit_table(tails.latest(found, spec), layout.table("tails"), mode="overwrite")
    return read_current(spark, layout.table(f"new_predictions/{part}"))
