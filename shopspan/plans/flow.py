"""The whole run, stage by stage: weekly tables, preparation, fit, comparison,
prediction, gold. Every stage stores its result and the next one reads the files, so a
lost executor costs at most the stage it worked on. Tables are checked before they
become visible."""

from __future__ import annotations

from datetime import datetime
from functools import wraps
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopspan.config import RetentionParams
from shopspan.functions.dates import normalize_end_date, reject_future
from shopspan.operators import calendar as cal
from shopspan.operators import evaluation as ev
from shopspan.operators import features as feat
from shopspan.operators import fitting, gold, pooling, quality, sampling, weekly
from shopspan.operators import predictions as pred
from shopspan.operators import regression as reg
from shopspan.operators import rolling_sales as rolling
from shopspan.operators import sequences as seq
from shopspan.schemas import ALL_FEATURES, HOUSEHOLD_CHURN_COLUMNS, STORE_FEATURE
from shopspan.sources import sinks
from shopspan.sources.snapshots import LONG_HISTORY, SHORT_HISTORY, VersionedTable
from shopspan.sources.staging import staged, staging_scope
from shopspan.sources.tables import SalesTables


#: The candidate that is no segmentation: two heads linear in the features.
FEATURES = "features"
#: The finest segmentation with its fits drawn towards coarser ones.
POOLED = "pooled"


class Model(NamedTuple):
    """A candidate of one version of the fits, a segmentation, POOLED or FEATURES; ``name`` labels it in results."""

    name: str
    candidate: str
    version: int


def _own_staging(stage):
    """What a stage stages is removed when its result is stored."""

    @wraps(stage)
    def run(self, *args, **kwargs):
        with staging_scope(self.spark):
            return stage(self, *args, **kwargs)

    return run


class RetentionFlow:
    """Stages over one set of sales tables; results live under ``root``."""

    def __init__(self, spark: SparkSession, tables: SalesTables, root: str, params: RetentionParams):
        self.spark, self.tables, self.p = spark, tables, params
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def versioned(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(name))

    # --- sales -> weekly tables ---------------------------------------------------

    @_own_staging
    def build_weekly_tables(self) -> None:
        t, p = self.tables, self.p
        dates, weeks = cal.read_keys(t.dim_date, cal.build_bounds(t.dim_date, p))
        rows = weekly.build_customer_weeks(t, dates, p.listed_banners)
        rows = staged(rows, "customer-weeks")
        quality.require(quality.check_customer_weeks(rows, p), "customer_weeks")
        sinks.overwrite(rows, self.path("customer_weeks"), "year_number", "week_number")

        households = staged(
            weekly.build_household_weeks(
                self.read("customer_weeks"), t, weeks, p.listed_banners, p.households_per_batch,
                numbers_path=self.path("household_numbers"), run_date=dates.max_date,
            ),
            "household-weeks",
        )
        quality.require(quality.check_household_weeks(households, p), "household_weeks")
        sinks.overwrite(households, self.path("household_weeks"), "hhn_batch_num")

    # --- weekly tables -> sequences -----------------------------------------------

    def _dense(self, subset: DataFrame, lookup: DataFrame, quantile: float | None):
        """Dense, rescaled sequences and the number of steps on their axis."""
        axis = seq.read_axis(subset)
        chosen = sampling.undersample(subset, quantile, self.p.sample_seed)
        inputs = feat.household_features(chosen, lookup, self.p.default_region)
        quality.require_feature_count(inputs, ALL_FEATURES)
        return feat.rescale(seq.densify(inputs, axis)), seq.axis_length(axis)

    @_own_staging
    def prepare(self, at: datetime | None = None) -> None:
        p, rows = self.p, self.read("household_weeks")
        reject_future(p.end_date_train)
        cal.week_window(self.tables.dim_date, rows, p.end_date_train, p.n_weeks_total_train)
        subset_key = ("year_number", "week_number")
        for name, part in (
            ("churn_train", sampling.train_subset(rows, p)),
            ("churn_test", sampling.test_subset(rows, p)),
        ):
            self.versioned(name).write(part, *subset_key, at=at)
        train = self.versioned("churn_train").read_as_of()
        test = self.versioned("churn_test").read_as_of()
        self.versioned("region_lookup").write(feat.region_lookup(train), at=at)
        lookup = self.versioned("region_lookup").read_as_of()

        dense, n_axis = self._dense(train, lookup, p.undersample_quantile)
        n_cut = seq.steps_to_cut(n_axis, p.n_validation_steps, p.validation_fraction)
        paired = seq.train_sequences(dense, n_axis, n_cut)
        sinks.overwrite(fitting.with_step_segments(paired), self.path("train_sequences"))

        dense, n_axis = self._dense(test, lookup, None)
        n = p.n_testing_steps
        held_out = seq.valid_sequences(dense, n_axis, n, n)
        self.versioned("test_sequences").write(fitting.with_step_segments(held_out), at=at)
        sinks.overwrite(self.spark.createDataFrame([(n_axis - n,)], "begin_k int"), self.path("test_begin"))
        # Train and test tables are kept for two years, what is made of them for a month.
        for name in ("churn_train", "churn_test"):
            self.versioned(name).expire(LONG_HISTORY, at)
        self.versioned("test_sequences").expire(SHORT_HISTORY, at)

    # --- sequences -> parameters --------------------------------------------------

    def training_is_due(self, now: datetime | None = None) -> bool:
        """No model yet, or the newest is too old."""
        age = self.versioned("fitted").last_operation(now).first()["days_since"]
        return age is None or age >= self.p.max_model_age_days

    @_own_staging
    def fit(self, at: datetime | None = None) -> int:
        """Fit every candidate, segments also pooled, and add one row of test metrics for each; returns the version.

        A version of ``fitted`` names the version of the region lookup its region numbers come from and that of the
        feature model fitted beside it.
        """
        train = self.read("train_sequences")
        start = fitting.init_alpha(train).first()["init_alpha"]
        heads = reg.fit_heads(reg.with_history(train), start)
        heads_version = self.versioned("heads").write(heads.table(self.spark), at=at)
        histogram = staged(fitting.candidate_histograms(train), "histograms")
        own = fitting.fit_weibull(histogram, list(pooling.KEYS), start)
        drawn = pooling.fit_pooled(histogram, start).select(*own.columns)
        both = own.withColumn("pooled", F.lit(False)).unionByName(drawn.withColumn("pooled", F.lit(True)))
        fitted = staged(both.withColumns({
            "heads_version": F.lit(heads_version).cast("long"),
            "fitted_at": F.lit(at or datetime.now()),
            "lookup_version": F.lit(self.versioned("region_lookup").newest_version()).cast("long"),
        }), "fitted")
        quality.require(quality.check_fits(fitted), "fitted")
        version = self.versioned("fitted").write(fitted, at=at)
        # Heads that did not converge are stored but not compared.
        names = [*fitting.CANDIDATES, POOLED, *([FEATURES] if heads.converged else [])]
        models = [Model(name, name, version) for name in names]
        runs = ev.mean_metrics(self.evaluate(models), ("model",)).select(
            F.col("model").alias("candidate"), "mean_auc", "mean_ap", "mean_ece",
            F.lit(at or datetime.now()).alias("start_time"), F.lit(version).cast("long").alias("version"),
        )
        runs.write.mode("append").parquet(self.path("runs"))
        return version

    def _with_regions_of(self, rows: DataFrame, fitted: DataFrame) -> DataFrame:
        """``rows`` with today's region numbers turned into those of a fit; others have none."""
        lookups = self.versioned("region_lookup")
        then = fitted.select("lookup_version").first()["lookup_version"]
        if then == lookups.newest_version():
            return rows
        # One row per sales region.
        numbers = lookups.read_as_of().select(feat.REGION, F.col(STORE_FEATURE).alias("region_id")).join(
            lookups.read_as_of(then).select(feat.REGION, F.col(STORE_FEATURE).alias("number_then")), feat.REGION
        ).drop(feat.REGION)
        return rows.join(F.broadcast(numbers), "region_id", "left").withColumn(
            "region_id", F.col("number_then").cast("int")
        ).drop("number_then")

    def _fitted(self, version: int) -> DataFrame:
        return self.versioned("fitted").read_as_of(version)

    def _score(self, rows: DataFrame, model: Model) -> DataFrame:
        """Alpha and beta of rows with segments and inputs, by a model of any kind."""
        fitted = self._fitted(model.version)
        if model.candidate == FEATURES:
            version = fitted.select("heads_version").first()["heads_version"]
            return reg.score_heads(rows, reg.heads_of(self.versioned("heads").read_as_of(version)))
        return self._by_segment(self._with_regions_of(rows, fitted), fitted, model)

    def _by_segment(self, rows: DataFrame, fitted: DataFrame, model: Model) -> DataFrame:
        drawn = model.candidate == POOLED
        return fitting.score(rows, fitted.where(F.col("pooled") == drawn), "regional" if drawn else model.candidate)

    def evaluate(self, models: list[Model], folds: bool = False) -> DataFrame:
        """Metrics per horizon of the given models on the test sequences.

        The sequences shrink to one row per household first; models are scored on those.
        """
        p, by = self.p, ("fold", "model") if folds else ("model",)
        begin = self.read("test_begin").first()["begin_k"]
        test = reg.with_history(self.versioned("test_sequences").read_as_of())
        values = (*fitting.CANDIDATES["regional"], *reg.INPUTS)
        frame = ev.evaluation_frame(
            test, begin, p.consider_last_event, values=values, known=("recency_bin", "frequency_bin")
        )
        if folds:
            frame = sampling.assign_folds(frame, p.n_folds, p.fold_seed)
        frame = staged(frame, "frame")
        scored = None
        for m in models:
            part = self._score(frame, m).withColumn("model", F.lit(m.name)).where("alpha IS NOT NULL AND beta IS NOT NULL")
            scored = part if scored is None else scored.unionByName(part)
        outcomes = ev.box_outcomes(scored, p.n_testing_steps, p.min_box_width, p.consider_last_event, by)
        return ev.horizon_metrics(staged(outcomes, "outcomes"), by)

    def promoted(self) -> Model | None:
        """The model in use: the newest row of the promotions."""
        rows = sinks.read_if_exists(self.spark, self.path("promoted"))
        last = None if rows is None else rows.orderBy(F.desc("promoted_at"), F.desc("version")).first()
        return None if last is None else Model("champion", last["candidate"], last["version"])

    @_own_staging
    def compare(self, now: datetime | None = None) -> dict:
        """Paired test of the best recent candidate against the model in use.

        On ``promote``, or ``default`` while there is none, the challenger becomes the model in use; on
        ``keep`` the champion stays. The result names the model to use: candidate and version.
        """
        p, at = self.p, now or datetime.now()
        champion = self.promoted()
        best = ev.best_run(self.read("runs"), F.lit(at), p.recent_runs_hours).first()
        if best is None:
            raise ValueError(f"no run within {p.recent_runs_hours} hours before {at} has a metric")
        challenger = Model("challenger", best["candidate"], best["version"])
        if champion is None:
            folds = self.spark.createDataFrame([], "fold int, champion double, challenger double")
        else:
            means = ev.mean_metrics(self.evaluate([champion, challenger], folds=True), ("fold", "model"))
            # One row per fold and model.
            folds = means.groupBy("fold").agg(*[
                F.max(F.when(F.col("model") == m, F.col("mean_auc"))).alias(m) for m in ("champion", "challenger")
            ])
        test = ev.promotion(ev.paired_t_test(folds, "champion", "challenger"), p.t_test_level).first().asDict()
        chosen = champion if test["decision"] == "keep" else challenger
        if chosen is challenger:
            row = self.spark.createDataFrame(
                [(at, chosen.candidate, chosen.version, test["decision"])],
                "promoted_at timestamp, candidate string, version long, decision string",
            )
            row.coalesce(1).write.mode("append").parquet(self.path("promoted"))
        return {**test, "candidate": chosen.candidate, "version": chosen.version}

    # --- parameters -> predictions ------------------------------------------------

    @_own_staging
    def predict(self, prediction_date=None) -> None:
        """Predictions of the model in use, with its own region lookup."""
        p, rows, model = self.p, self.read("household_weeks"), self.promoted()
        if model is None:
            raise ValueError("no model is in use yet: fit and compare first")
        reject_future(p.end_date_pred)
        cal.week_window(self.tables.dim_date, rows, p.end_date_pred, p.n_weeks_total_pred)
        chosen = sampling.prediction_subset(rows, p)
        fitted = self._fitted(model.version)
        lookup = self.versioned("region_lookup").read_as_of(fitted.select("lookup_version").first()[0])
        sinks.overwrite(feat.unseen_regions(chosen, lookup), self.path("unseen_regions"))
        inputs = feat.household_features(chosen, lookup, p.default_region)
        current = reg.current_inputs(inputs, seq.read_axis(chosen))
        # The region numbers of ``current`` are those of the fit already.
        if model.candidate == FEATURES:
            scored = self._score(current, model)
        else:
            scored = self._by_segment(current, fitted, model)
        week = cal.read_last_complete_week(self.tables.dim_date, p.end_date_pred)
        kpis = pred.household_kpis(rows, week, p.n_weeks_stats)
        output = staged(
            pred.churn_output(
                scored, kpis, p.n_weeks_churn, f"{model.candidate}/{model.version}", prediction_date
            ), "churn-output"
        )
        quality.require(quality.check_churn_output(output, p), "churn_output")
        quality.require_single_value(output, "max_week_ending_date")
        sinks.overwrite_partitions(output, self.path("churn_output"), "max_week_ending_date")

    # --- predictions -> gold ------------------------------------------------------

    @_own_staging
    def build_gold(self, sales: DataFrame, customers: DataFrame, items: DataFrame) -> None:
        p, dates = self.p, self.tables.dim_date
        latest = staged(pred.latest_predictions(self.read("churn_output")), "latest")
        if p.end_date_pred is None:
            week = cal.newest_week(latest).first()["max_wed"]
        else:
            week = cal.read_last_complete_week(dates, normalize_end_date(p.end_date_pred))
        # Earlier weeks have not changed since their own runs.
        latest = latest.where(F.col("max_week_ending_date") == F.lit(week))
        if p.rolling_sales:
            path = self.path("rolling_sales")
            rolling.advance_stored(path, sales, items, dates, week, p.lookback_years)
            annualized = rolling.annualized_from_window(
                rolling.stored_window(path, sales, week), customers, week, p.excluded_card_types, p.period_weeks
            )
        else:
            annualized = gold.annualized_sales(
                sales, customers, items, dates, week, p.excluded_card_types, p.lookback_years, p.period_weeks
            )
        sinks.merge_into(
            self.path("household_annualized_sales"), annualized, "churn_max_week_ending_date",
            **gold.ANNUALIZED_MERGE,
        )
        churn = staged(
            gold.household_churn(
                self.read("household_annualized_sales").where(F.col("churn_max_week_ending_date") == F.lit(week)), latest
            ), "household-churn"
        )
        quality.require(
            quality.check_household_churn(churn, dates, p, HOUSEHOLD_CHURN_COLUMNS), "household_churn"
        )
        sinks.merge_into(self.path("household_churn"), churn, "max_week_ending_date", **gold.CHURN_MERGE)

    def run(self, sales: DataFrame, customers: DataFrame, items: DataFrame, prediction_date=None) -> DataFrame:
        self.build_weekly_tables()
        if self.training_is_due():
            self.prepare()
            self.fit()
            self.compare()
        self.predict(prediction_date)
        self.build_gold(sales, customers, items)
        return self.read("household_churn")
