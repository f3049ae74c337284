"""Queries over the test star schema, one per operator or group of operators."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import wraps

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopspan.functions import weibull as wb
from shopspan.operators import calendar as cal
from shopspan.operators import evaluation as ev
from shopspan.operators import features as feat
from shopspan.operators import fitting, gold, pooling, quality, reports
from shopspan.operators import household_state as hs
from shopspan.operators import predictions as pred
from shopspan.operators import regression as reg
from shopspan.operators import rolling_sales as rolling
from shopspan.operators import sampling, stable_batches, weekly
from shopspan.operators import sequences as seq
from shopspan.plans.sample_setting import END_DATE, SAMPLE_PARAMS
from shopspan.schemas import ALL_FEATURES, HOUSEHOLD_CHURN_COLUMNS, NUMERIC_FEATURES
from shopspan.plans.flow import RetentionFlow
from shopspan.sources import sinks
from shopspan.sources import tables as src
from shopspan.sources.snapshots import SHORT_HISTORY, VersionedTable
from shopspan.sources.staging import new_staging_path, staged

P = SAMPLE_PARAMS
REGISTRY: dict = {}


def query(fn):
    """Register ``fn`` under its name; decimals leave as doubles, small ints as ints."""

    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain_types(fn(spark, folder))

    REGISTRY[fn.__name__] = run
    return run


def plain_types(df: DataFrame) -> DataFrame:
    def tidy(field):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType)):
            return F.col(field.name).cast("int").alias(field.name)
        return F.col(field.name)

    return df.select(*[tidy(f) for f in df.schema.fields])


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def weeks_apart(first, last) -> int:
    return (last - first).days // 7


# --- shared stages ------------------------------------------------------------


def _setting(spark, folder):
    """Tables, and the dates and weeks of the run."""
    t = src.sales_tables(spark, folder)
    return t, *cal.read_keys(t.dim_date, cal.build_bounds(t.dim_date, P))


def _customer_weeks(spark, folder):
    t, dates, weeks = _setting(spark, folder)
    return t, weeks, weekly.build_customer_weeks(t, dates, P.listed_banners)


def _store_weeks(spark, folder):
    t, weeks, cx = _customer_weeks(spark, folder)
    return t, weekly.household_store_weeks(cx, t.dim_customer, weeks, tasks=t.line_tasks)


def _household_weeks(spark, folder):
    t, weeks, cx = _customer_weeks(spark, folder)
    rows = weekly.build_household_weeks(cx, t, weeks, P.listed_banners, P.households_per_batch)
    return t, staged(rows, "household-weeks")


# --- calendar -----------------------------------------------------------------


@query
def min_max_complete_weeks(spark, folder):
    return cal.complete_week_bounds(src.dim_date(spark, folder), END_DATE, P.n_weeks_total_train)


@query
def key_dates(spark, folder):
    days = src.dim_date(spark, folder)
    return cal.key_dates(days, cal.build_bounds(days, P))


@query
def key_weeks(spark, folder):
    days = src.dim_date(spark, folder)
    return cal.key_weeks(days, cal.build_bounds(days, P))


# --- weekly tables ------------------------------------------------------------


@query
def transaction_grain(spark, folder):
    t, key, _ = _setting(spark, folder)
    return weekly.transaction_grain(
        t.retail_sale, t.dim_location, t.dim_product, key, P.listed_banners, t.line_tasks
    )


@query
def ecomm_flag_join(spark, folder):
    t, key, _ = _setting(spark, folder)
    flagged = weekly.flagged_transactions(
        t.retail_sale, t.dim_location, t.dim_product, key, P.listed_banners, t.line_tasks
    )
    return flagged.select(
        *weekly.TRANSACTION_KEYS, F.coalesce("ecomm_flag", F.lit(0)).alias("ecomm_flag")
    )


@query
def customer_weeks(spark, folder):
    return _customer_weeks(spark, folder)[2]


@query
def top_store(spark, folder):
    return weekly.top_stores(_store_weeks(spark, folder)[1])


@query
def household_weeks(spark, folder):
    return _household_weeks(spark, folder)[1]


@query
def household_batches(spark, folder):
    t, store_weeks = _store_weeks(spark, folder)
    totals = weekly.household_totals(store_weeks, t.dim_date)
    return weekly.household_batches(totals, P.households_per_batch)


@query
def stable_household_batches(spark, folder):
    """Numbers of three runs: households of the first five weeks, then all, then all again."""
    t, store_weeks = _store_weeks(spark, folder)
    rows = staged(weekly.household_totals(store_weeks, t.dim_date).select("hhn", "week_ending_date"), "household-ids")
    path = new_staging_path(spark, "household-numbers")
    first = rows.agg(F.min("week_ending_date")).first()[0] + timedelta(weeks=4)
    for run, ids in enumerate((rows.where(F.col("week_ending_date") <= F.lit(first)), rows, rows)):
        stable_batches.extend(path, ids, first + timedelta(weeks=run))
    runs = stable_batches.numbers(path, spark).select(
        "hhn", (F.datediff("added", F.lit(first)) / 7 + 1).cast("int").alias("run")
    )
    return stable_batches.batches(path, spark, P.households_per_batch).join(runs, "hhn")


# --- windows, splits, sampling ------------------------------------------------


def _window_rows(spark, folder):
    """Every household's rows inside the training window."""
    t, rows = _household_weeks(spark, folder)
    return t, sampling.subset(rows, END_DATE, P.n_weeks_total_train, fraction=None)


@query
def week_window(spark, folder):
    t, rows = _household_weeks(spark, folder)
    span = cal.week_window(t.dim_date, rows, END_DATE, P.n_weeks_total_pred)
    return spark.createDataFrame(
        [(span.first, span.last, weeks_apart(span.first, span.last) + 1)],
        "start_week_ending_date date, end_week_ending_date date, n_weeks int",
    )


@query
def history_window(spark, folder):
    return _window_rows(spark, folder)[1]


@query
def hash_split_train_test(spark, folder):
    _, rows = _household_weeks(spark, folder)
    train = sampling.train_subset(rows, P).select(F.lit("train").alias("part"), "hhn")
    test = sampling.test_subset(rows, P).select(F.lit("test").alias("part"), "hhn")
    return train.unionByName(test).groupBy("part", "hhn").agg(F.count(F.lit(1)).alias("n_weeks"))


@query
def prediction_halves(spark, folder):
    _, rows = _household_weeks(spark, folder)
    low = sampling.prediction_half(rows, P, True).select(F.lit("low").alias("half"), "hhn")
    high = sampling.prediction_half(rows, P, False).select(F.lit("high").alias("half"), "hhn")
    return low.unionByName(high).groupBy("half", "hhn").agg(F.count(F.lit(1)).alias("n_weeks"))


@query
def size_bins(spark, folder):
    return sampling.size_bins(_window_rows(spark, folder)[1])


@query
def bin_cutoff(spark, folder):
    return sampling.bin_cutoff(
        sampling.size_bins(_window_rows(spark, folder)[1]), P.undersample_quantile
    )


@query
def undersample(spark, folder):
    _, rows = _window_rows(spark, folder)
    kept = sampling.undersample(rows, P.undersample_quantile, P.sample_seed)
    return kept.select("hhn", "week_ending_date", "n_transaction")


@query
def folds(spark, folder):
    _, rows = _window_rows(spark, folder)
    return sampling.assign_folds(rows.select("hhn").distinct(), P.n_folds, P.fold_seed)


# --- features -----------------------------------------------------------------


@query
def region_lookup(spark, folder):
    return feat.region_lookup(_window_rows(spark, folder)[1])


def _one_banner_lookup(spark, folder):
    """All household weeks, and a lookup that only knows the regions of one banner."""
    t, rows = _household_weeks(spark, folder)
    known = weekly.listed_stores(t.dim_location, ("AMERICA",)).select(feat.REGION).distinct()
    return rows, staged(feat.region_lookup(rows.join(known, feat.REGION, "left_semi")), "regions")


@query
def region_index(spark, folder):
    rows, lookup = _one_banner_lookup(spark, folder)
    indexed = feat.with_region_index(rows, lookup, P.default_region)
    return indexed.select("hhn", "week_ending_date", feat.REGION, "div_reg_index")


@query
def unseen_regions(spark, folder):
    rows, lookup = _one_banner_lookup(spark, folder)
    return feat.unseen_regions(rows, lookup)


@query
def region_cardinality(spark, folder):
    _, rows = _window_rows(spark, folder)
    lookup = staged(feat.region_lookup(rows), "regions")
    return feat.region_cardinality(feat.with_region_index(rows, lookup, P.default_region))


def _features(spark, folder):
    _, rows = _window_rows(spark, folder)
    lookup = staged(feat.region_lookup(rows), "regions")
    return rows, feat.household_features(rows, lookup, P.default_region)


@query
def features(spark, folder):
    rows = feat.rescale(_features(spark, folder)[1])
    return rounded(rows, 6, *NUMERIC_FEATURES)


# --- sequences ----------------------------------------------------------------


def _dense_of(rows, inputs):
    axis = seq.read_axis(rows)
    return feat.rescale(seq.densify(inputs, axis)), seq.axis_length(axis)


def _dense(spark, folder):
    return _dense_of(*_features(spark, folder))


@query
def densify(spark, folder):
    dense, _ = _dense(spark, folder)
    return rounded(dense, 6, *ALL_FEATURES)


@query
def prediction_sequences(spark, folder):
    rows, inputs = _features(spark, folder)
    return rounded(seq.prediction_sequences(inputs, seq.read_axis(rows)), 6, *ALL_FEATURES)


def _targets(spark, folder, **kind):
    return seq.with_targets(seq.flag_events(_dense(spark, folder)[0]), **kind)


@query
def tte_discrete(spark, folder):
    return _targets(spark, folder).select("hhn", "k", "t", "event", "tte")


@query
def tte_continuous(spark, folder):
    # Elapsed days instead of steps as the time scale.
    dense = seq.flag_events(_dense(spark, folder)[0]).withColumn("elapsed", F.col("t") * 7)
    rows = seq.with_targets(dense, discrete=False, position="elapsed")
    return rows.select("hhn", "k", "t", "elapsed", "tte")


@query
def censoring(spark, folder):
    rows = seq.flag_events(_dense(spark, folder)[0])
    return rows.select(
        "hhn", "k",
        seq.uncensored_discrete().alias("u_discrete"),
        seq.uncensored_continuous().alias("u_continuous"),
    )


@query
def sequence_lengths(spark, folder):
    return seq.sequence_lengths(_dense(spark, folder)[0])


def _train(spark, folder):
    return _train_of(*_dense(spark, folder))


def _train_of(dense, n_axis):
    return seq.train_sequences(dense, n_axis, P.n_validation_steps)


def _valid(spark, folder):
    """Held-out sequences with the step at which the evaluation starts."""
    return _valid_of(*_dense(spark, folder))


def _valid_of(dense, n_axis):
    n = P.n_testing_steps
    return seq.valid_sequences(dense, n_axis, n, n), n_axis, n_axis - n


@query
def train_sequences(spark, folder):
    rows = _train(spark, folder)
    return rounded(rows, 6, *ALL_FEATURES)


@query
def valid_sequences(spark, folder):
    dense, n_axis = _dense(spark, folder)
    rows = seq.valid_sequences(dense, n_axis, P.n_testing_steps, 5)
    return rounded(rows, 6, *ALL_FEATURES)


@query
def time_since_last_event(spark, folder):
    rows, _, begin = _valid(spark, folder)
    return seq.time_since_last_event(rows, begin - 1)


@query
def dense_export_roundtrip(spark, folder):
    rows, n_axis, _ = _valid(spark, folder)
    columns = [*ALL_FEATURES, "tte", "u"]
    fills = [P.mask_value] * len(ALL_FEATURES) + [3.5, P.censor_dummy]
    packed = seq.pack_sequences(rows, n_axis - 1, columns, fills)
    unpacked = seq.unpack_sequences(packed, columns).withColumn(
        "weight", seq.mask_weight(P.mask_value, ALL_FEATURES[0])
    )
    return rounded(seq.unmask(unpacked, ["tte"]), 6, *ALL_FEATURES)


# --- Weibull functions ----------------------------------------------------------


def _gap_rule(paired, *keep):
    """Simple closed-form parameters, so that results can be checked in SQL:
    alpha is the mean gap between purchases so far, beta grows with their number."""
    before = Window.partitionBy("hhn").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    prior = F.coalesce(F.sum("event").over(before), F.lit(0)) + 1
    return paired.select("hhn", "k", "t", "tte", "u", *keep, prior.alias("prior")).withColumns(
        {
            "alpha": F.round(F.col("t") / F.col("prior"), 6),
            "beta": F.round(0.75 + F.col("prior") / (F.col("prior") + 8), 6),
        }
    )


def _scored_valid(spark, folder):
    rows, _, begin = _valid(spark, folder)
    return _gap_rule(rows), begin


@query
def weibull_functions(spark, folder):
    rows, _ = _scored_valid(spark, folder)
    t, a, b = F.col("tte") + 1, F.col("alpha"), F.col("beta")
    out = rows.select(
        "hhn", "k",
        wb.cumulative_hazard(t, a, b).alias("cumulative_hazard"),
        wb.hazard(t, a, b).alias("hazard"),
        wb.cdf(t, a, b).alias("cdf"),
        wb.pdf(t, a, b).alias("pdf"),
        wb.cmf(t, a, b).alias("cmf"),
        wb.pmf(t, a, b).alias("pmf"),
        wb.mode(a, b).alias("mode"),
        wb.mean(a, b).alias("mean"),
        wb.quantile(a, b, 0.5).alias("median"),
        wb.excess_pdf(F.col("t"), t, a, b).alias("excess_pdf"),
        wb.excess_cdf(F.col("t"), t, a, b).alias("excess_cdf"),
        wb.excess_quantile(F.col("t"), a, b, 0.5).alias("excess_median"),
    )
    return rounded(out, 5, *out.columns[2:])


@query
def output_transform(spark, folder):
    rows, _ = _scored_valid(spark, folder)
    alpha, beta = wb.output_transform(
        F.col("prior") / F.col("t"), F.col("u") - 0.5, init_alpha=10.0, max_beta=5.0, scale=0.4
    )
    return rows.select(
        "hhn", "k", F.round(alpha, 5).alias("alpha"), F.round(beta, 5).alias("beta")
    )


@query
def censored_loglik(spark, folder):
    rows, _ = _scored_valid(spark, folder)
    t, a, b, u = F.col("tte"), F.col("alpha"), F.col("beta"), F.col("u")
    out = rows.select(
        "hhn", "k",
        wb.discrete_loglik(t, a, b, u).alias("discrete"),
        wb.discrete_loglik(t, a, b, u, equality=True).alias("discrete_equality"),
        wb.continuous_loglik(t + 1, a, b, u).alias("continuous"),
        wb.continuous_loglik(t + 1, a, b, u, equality=True).alias("continuous_equality"),
        wb.training_loglik(t, a, b, u).alias("training"),
    )
    return rounded(out, 5, *out.columns[2:])


@query
def loss(spark, folder):
    rows, _ = _scored_valid(spark, folder)
    t, a, b, u = F.col("tte"), F.col("alpha"), F.col("beta"), F.col("u")
    return rows.agg(
        F.round(F.avg(wb.loss(t, a, b, u, clip_prob=1e-5)), 6).alias("discrete_loss"),
        F.round(F.avg(wb.loss(t + 1, a, b, u, "continuous")), 6).alias("continuous_loss"),
    )


@query
def init_alpha(spark, folder):
    rows = fitting.init_alpha(_train(spark, folder))
    return rounded(rows, 6, "mean_tte", "mean_u", "init_alpha")


# --- fitting and scoring --------------------------------------------------------


def _train_segments(spark, folder):
    return fitting.with_step_segments(_train(spark, folder))


def _train_segments_of(rows, inputs):
    """The same from features that the query reads again for something else."""
    return fitting.with_step_segments(_train_of(*_dense_of(rows, inputs)))


@query
def step_segments(spark, folder):
    rows = _train_segments(spark, folder)
    return rows.select(
        "hhn", "k", "recency", "n_events", "region_id", "recency_bin", "frequency_bin"
    )


@query
def current_segments(spark, folder):
    rows, inputs = _features(spark, folder)
    return fitting.current_segments(inputs, seq.read_axis(rows))


@query
def tte_histogram(spark, folder):
    return fitting.tte_histogram(_train_segments(spark, folder), fitting.CANDIDATES["regional"])


@query
def fit_weibull(spark, folder):
    train = staged(_train_segments(spark, folder), "train")
    start = fitting.init_alpha(train).first()["init_alpha"]
    fitted = fitting.fit_candidates(train, start)
    return rounded(fitted, 4, "alpha", "beta", "mean_loglik")


@query
def fit_optimality(spark, folder):
    """Every fitted segment against its neighbours, on the histogram it was fitted to."""
    train = _train_segments(spark, folder)
    start = fitting.init_alpha(train).first()["init_alpha"]
    histogram = staged(fitting.candidate_histograms(train), "histograms")
    fitted = fitting.fit_weibull(histogram, ["candidate", *fitting.CANDIDATES["regional"]], start)
    found = fitting.fit_optimality(histogram, staged(fitted, "fitted"))
    return found.fillna(-1, list(fitting.CANDIDATES["regional"]))  # -1: the candidate does not use it


@query
def score_closed_form(spark, folder):
    """Scoring with its fallbacks; closed-form parameters stand in for fitted ones."""
    keys = ["candidate", *fitting.CANDIDATES["regional"]]
    n, events = F.sum("weight"), F.sum(F.col("weight") * F.col("u"))
    rows, inputs = _features(spark, folder)
    fitted = staged(
        fitting.candidate_histograms(_train_segments_of(rows, inputs)).groupBy(*keys)
        .agg((n / events).alias("alpha"), (1 + 1 / (1 + events)).alias("beta"), events.alias("n_events"))
        .where("n_events > 0"), "fitted",
    )
    scored = fitting.score(fitting.current_segments(inputs, seq.read_axis(rows)), fitted)
    return rounded(scored.select("hhn", "alpha", "beta"), 6, "alpha", "beta")


@query
def score_households(spark, folder):
    rows, inputs = _features(spark, folder)
    train = staged(_train_segments_of(rows, inputs), "train")
    start = fitting.init_alpha(train).first()["init_alpha"]
    fitted = staged(fitting.fit_candidates(train, start), "fitted")
    scored = fitting.score(fitting.current_segments(inputs, seq.read_axis(rows)), fitted)
    return rounded(scored.select("hhn", "alpha", "beta"), 4, "alpha", "beta")


# --- weekly state ------------------------------------------------------------------


def _moved_state(spark, rows, last, n_weeks, n_moves):
    """Path of states: a full build ``n_moves`` weeks ago, then one stored week after the other."""
    path = new_staging_path(spark, "household-state")
    for back in range(n_moves, -1, -1):
        hs.advance_stored(path, rows, last - timedelta(weeks=back), n_weeks)
    return path


@query
def household_state(spark, folder):
    """State of a window of 20 weeks after six weekly moves, in which six weeks leave it."""
    rows = staged(_window_rows(spark, folder)[1], "rows")
    last = seq.read_axis(rows).last
    state = hs.stored_state(_moved_state(spark, rows, last, 20, 6), spark, last)
    return state.select(
        "hhn", *[F.array_join(F.transform(c, lambda d: d.cast("string")), ",").alias(c) for c in ("weeks", "events")], feat.REGION
    )


@query
def state_segments(spark, folder):
    """Segments from a state moved on twice, over all weeks of the prediction window."""
    rows = staged(_window_rows(spark, folder)[1], "rows")
    axis = seq.read_axis(rows)
    path = _moved_state(spark, rows, axis.last, seq.axis_length(axis), 2)
    lookup = staged(feat.region_lookup(rows), "regions")
    return hs.state_segments(hs.stored_state(path, spark, axis.last), axis.last, lookup, P.default_region)


# --- pooled segments ---------------------------------------------------------------


def _closed_estimates(spark, folder):
    """Estimates of each segment by rules that SQL can follow, in place of fitted ones."""
    keys = list(pooling.KEYS)
    n, events = F.sum("weight"), F.sum(F.col("weight") * F.col("u"))
    return fitting.candidate_histograms(_train_segments(spark, folder)).groupBy(*keys).agg(
        n.alias("n_rows"), events.alias("n_events")
    ).select(
        *keys, F.when(F.col("n_events") > 0, F.ln(F.col("n_rows") / F.col("n_events"))).alias("ln_alpha"),
        F.when(F.col("n_events") > 0, 1 / (1 + F.col("n_events"))).alias("ln_beta"),
        *[F.when(F.col("n_events") > 0, k / F.col("n_events")).alias(f"variance_{p}") for p, k in (("alpha", 1), ("beta", 2))],
    )


@query
def segment_pooling(spark, folder):
    """Priors and closed-form posteriors of all segments, from estimates by a rule."""
    found = pooling.pooled(_closed_estimates(spark, folder)).drop("variance_alpha", "variance_beta")
    numbers = [f"{k}_{p}" for k in ("ln", "centre", "spread") for p in pooling.PARAMETERS]
    return rounded(found, 6, *numbers).fillna(-1, list(fitting.CANDIDATES["regional"]))


@query
def pooled_fit_optimality(spark, folder):
    """Every pooled fit against its neighbours: no higher posterior on the segment's own histogram."""
    train = staged(_train_segments(spark, folder), "train")
    start = fitting.init_alpha(train).first()["init_alpha"]
    histogram = staged(fitting.candidate_histograms(train), "histograms")
    found = pooling.pooled_optimality(histogram, staged(pooling.fit_pooled(histogram, start), "fitted"))
    return found.fillna(-1, list(fitting.CANDIDATES["regional"]))


@query
def pooled_held_out(spark, folder):
    """Likelihood of the held-out steps under the pooled fits and under the segments' own fits."""
    dense = _dense(spark, folder)
    train = staged(fitting.with_step_segments(_train_of(*dense)), "train")
    start = fitting.init_alpha(train).first()["init_alpha"]
    histogram = staged(fitting.candidate_histograms(train), "histograms")
    fits = {"own": fitting.fit_weibull(histogram, list(pooling.KEYS), start), "pooled": pooling.fit_pooled(histogram, start)}
    rows, _, begin = _valid_of(*dense)
    held_out = staged(fitting.with_step_segments(rows).where(F.col("k") >= begin), "held-out")
    parts = [
        fitting.score(held_out, staged(fitted, name)).agg(
            F.lit(name).alias("fits"), F.count(F.lit(1)).alias("n_rows"), F.avg(pooling.row_loglik()).alias("mean_loglik")
        )
        for name, fitted in fits.items()
    ]
    return rounded(parts[0].unionByName(parts[1]), 6, "mean_loglik")


# --- parameters from the features --------------------------------------------------


def _head_rows(spark, folder):
    return _head_rows_of(_train_segments(spark, folder))


def _head_rows_of(segments):
    return staged(reg.with_history(segments), "head-rows")


def _ruled_heads(rows):
    """Weights by a rule in place of fitted ones, so that SQL can follow."""
    weights = np.array([((k % 5) - 2) * 0.05 for k in range(2 * (len(reg.INPUTS) + 1))])
    return reg.HeadFit(weights, reg.scales(rows), 10.0, 0.0, 0.0, 0.0, True, 0.0)


@query
def feature_likelihood(spark, folder):
    """Mean log-likelihood and its gradient as the fit adds them up, at weights by a rule."""
    rows = _head_rows(spark, folder)
    fit = _ruled_heads(rows)
    sums = reg.likelihood_sums(rows, fit.weights, fit.scale, fit.start_alpha)
    names = [(head, c) for head in reg.HEADS for c in ("intercept", *reg.INPUTS)]
    found = [("all", "loglik", float(sums.loglik / sums.n))] + [
        (head, c, float(g / sums.n)) for (head, c), g in zip(names, sums.gradient)
    ]
    return rounded(spark.createDataFrame(found, "head string, input string, value double"), 6, "value")


@query
def feature_fit_optimality(spark, folder):
    """The fitted heads: no input has a slope left, by the likelihood's own expressions."""
    rows = _head_rows(spark, folder)
    fit = reg.fit_heads(rows, fitting.init_alpha(rows).first()["init_alpha"])
    return reg.head_gradient(rows, fit).select(
        "head", "input", (F.abs("gradient") < 1e-4).alias("flat"), F.lit(fit.converged).alias("converged")
    )


@query
def feature_scores(spark, folder):
    """Households scored as of the axis end by heads with weights by a rule."""
    rows, inputs = _features(spark, folder)
    fit = _ruled_heads(_head_rows_of(_train_segments_of(rows, inputs)))
    scored = reg.score_heads(reg.current_inputs(inputs, seq.read_axis(rows)), fit)
    return rounded(scored.select("hhn", "alpha", "beta"), 6, "alpha", "beta")


@query
def feature_model_metrics(spark, folder):
    """Held-out metrics of the feature model beside those of the segment fits."""
    dense = _dense(spark, folder)
    train = _head_rows_of(fitting.with_step_segments(_train_of(*dense)))
    start = fitting.init_alpha(train).first()["init_alpha"]
    fitted = staged(fitting.fit_candidates(train, start), "fitted")
    rows, _, begin = _valid_of(*dense)
    held_out = staged(reg.with_history(fitting.with_step_segments(rows)), "held-out")
    scored = reg.score_heads(held_out, reg.fit_heads(train, start)).withColumn("model", F.lit("features"))
    keep = ["model", *rows.columns, "alpha", "beta"]
    scored = scored.select(*keep)
    for name in fitting.CANDIDATES:
        part = fitting.score(held_out, fitted, name).withColumn("model", F.lit(name))
        scored = scored.unionByName(part.where("alpha IS NOT NULL").select(*keep))
    outcomes = ev.evaluation_frame(scored, begin, P.consider_last_event, ("model",))
    boxes = ev.box_outcomes(outcomes, P.n_testing_steps, P.min_box_width, P.consider_last_event, ("model",))
    means = ev.mean_metrics(ev.horizon_metrics(staged(boxes, "outcomes"), ("model",)), ("model",))
    return rounded(means.select("model", "mean_auc", "mean_ap", "mean_ece"), 6, "mean_auc", "mean_ap", "mean_ece")


# --- churn metrics ----------------------------------------------------------------


def _frame(spark, folder):
    rows, begin = _scored_valid(spark, folder)
    return ev.evaluation_frame(rows, begin, P.consider_last_event)


def _outcomes(spark, folder):
    # Nine digits, so that two engines agree on which scores are equal.
    rows = ev.box_outcomes(
        _frame(spark, folder), P.n_testing_steps, P.min_box_width, P.consider_last_event
    )
    return staged(rounded(rows, 9, "score"), "outcomes")


@query
def eval_frame_without_last_event(spark, folder):
    rows, begin = _scored_valid(spark, folder)
    return ev.evaluation_frame(rows, begin, consider_last_event=False)


@query
def eval_frame(spark, folder):
    return _frame(spark, folder)


@query
def packed_evaluation(spark, folder):
    """The same frame from the exported vectors: unpack, drop the filling, align, score."""
    rows, n_axis, begin = _valid(spark, folder)
    columns = [*ALL_FEATURES, "tte", "u"]
    fills = [P.mask_value] * len(ALL_FEATURES) + [3.5, P.censor_dummy]
    packed = staged(seq.pack_sequences(rows, n_axis - 1, columns, fills), "packed")
    steps = seq.unmask(seq.unpack_sequences(packed, columns), ["tte"]).where("u IS NOT NULL")
    aligned = seq.left_padded(steps, n_axis - 1).withColumns(
        {"tte": F.col("tte").cast("int"), "event": (F.col("tte") == 0).cast("int")}
    )
    return ev.evaluation_frame(_gap_rule(aligned), begin, P.consider_last_event)


@query
def box_outcomes(spark, folder):
    return _outcomes(spark, folder)


@query
def calibration(spark, folder):
    bins = ev.probability_bins(_outcomes(spark, folder))
    return rounded(bins, 6, "mean_label", "mean_score", "fraction")


@query
def calibration_error(spark, folder):
    ece = ev.calibration_error(ev.probability_bins(_outcomes(spark, folder)))
    return rounded(ece, 6, "ece")


@query
def roc_points(spark, folder):
    points = ev.roc_points(ev.score_steps(_outcomes(spark, folder)))
    return rounded(points, 6, "fpr", "tpr", "threshold")


@query
def pr_points(spark, folder):
    points = ev.pr_points(ev.score_steps(_outcomes(spark, folder)))
    return rounded(points, 6, "precision", "recall", "threshold")


@query
def horizon_metrics(spark, folder):
    metrics = ev.horizon_metrics(_outcomes(spark, folder))
    return rounded(metrics, 6, "auc", "ap", "ece", "frac_in_box")


@query
def mean_metrics(spark, folder):
    means = ev.mean_metrics(ev.horizon_metrics(_outcomes(spark, folder)))
    return rounded(means, 6, "mean_auc", "mean_ap", "mean_ece")


def _fold_metrics(spark, folder):
    rows, begin = _scored_valid(spark, folder)
    models = F.array(
        F.struct(F.lit("champion").alias("model"), F.col("alpha"), F.lit(1.0).alias("beta")),
        F.struct(F.lit("challenger").alias("model"), F.col("alpha"), F.col("beta")),
    )
    both = sampling.assign_folds(rows, P.n_folds, P.fold_seed).select(
        "hhn", "fold", "k", "tte", F.explode(models).alias("m")
    ).select("hhn", "fold", "k", "tte", "m.*")
    by = ("fold", "model")
    frame = ev.evaluation_frame(both, begin, P.consider_last_event, by)
    outcomes = ev.box_outcomes(
        frame, P.n_testing_steps, P.min_box_width, P.consider_last_event, by
    )
    outcomes = staged(rounded(outcomes, 9, "score"), "outcomes")
    return ev.mean_metrics(ev.horizon_metrics(outcomes, by), by)


@query
def fold_metrics(spark, folder):
    return rounded(_fold_metrics(spark, folder), 6, "mean_auc", "mean_ap", "mean_ece")


@query
def fold_compare(spark, folder):
    scores = _fold_metrics(spark, folder)
    per_fold = scores.groupBy("fold").pivot("model", ["champion", "challenger"]).agg(
        F.first("mean_auc")
    )
    test = ev.promotion(ev.paired_t_test(per_fold, "champion", "challenger"), P.t_test_level)
    return rounded(
        test, 5, "mean_champion", "mean_challenger", "gap", "spread", "statistic", "p_value"
    )


@query
def fold_compare_edges(spark, folder):
    """The paired test where it used to break: equal gaps, tiny spread, equal scores, one fold, no fold."""
    scores = _fold_metrics(spark, folder).where("model = 'champion'").select("fold", F.col("mean_auc").alias("champion"))
    scores = staged(scores, "folds")
    # Powers of two keep sums and differences exact.
    base = F.round(F.col("champion") * 64) / 64
    cases = {
        "constant_up": (base, base + 0.125, F.lit(True)),
        "constant_down": (base, base - 0.125, F.lit(True)),
        "tiny_spread": (F.lit(0.0), 0.125 + F.col("fold") * 2.0**-20, F.lit(True)),
        "equal": (base, base, F.lit(True)),
        "one_fold": (base, base + 0.125, F.col("fold") == 0),
        "no_fold": (base, base, F.lit(False)),
    }
    parts = []
    for name, (champion, challenger, kept) in cases.items():
        folds = scores.where(kept).select("fold", champion.alias("champion"), challenger.alias("challenger"))
        test = ev.promotion(ev.paired_t_test(folds, "champion", "challenger"), P.t_test_level)
        parts.append(test.select(
            F.lit(name).alias("case"), "n_folds", F.col("p_value").isNull().alias("undefined"),
            F.coalesce(F.col("p_value").between(0, 1), F.lit(False)).alias("p_in_0_1"),
            F.coalesce(F.col("p_value") < 1e-9, F.lit(False)).alias("p_near_0"), "decision",
        ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def best_run(spark, folder):
    """Runs are the folds' challengers and champions, started one hour apart."""
    runs = _fold_metrics(spark, folder).withColumn(
        "start_time",
        F.lit(END_DATE).cast("timestamp") - F.make_dt_interval(hours=F.col("fold") * 10),
    )
    best = ev.best_run(runs, F.lit(END_DATE).cast("timestamp"), P.recent_runs_hours)
    return rounded(best.select("fold", "model", "mean_auc"), 6, "mean_auc")


# --- business reports ---------------------------------------------------------------


def _one_horizon(spark, folder):
    rows = _outcomes(spark, folder).where(F.col("box_width") == P.n_weeks_churn)
    return rows.select("hhn", "score", "churned")


@query
def risk_report(spark, folder):
    report = reports.risk_report(_one_horizon(spark, folder), 4, reports.FOUR_BIN_NAMES)
    return rounded(
        report, 6, "mean_prob", "median_prob", "percent_churned", "percent_of_total_churned"
    )


@query
def risk_report_deciles(spark, folder):
    report = reports.risk_report(_one_horizon(spark, folder), 10)
    return rounded(
        report, 6, "mean_prob", "median_prob", "percent_churned", "percent_of_total_churned"
    )


@query
def risk_report_check(spark, folder):
    check = reports.risk_report_check(_one_horizon(spark, folder), 10)
    return rounded(check, 6, "percent_churned")


@query
def score_histogram(spark, folder):
    return reports.score_histogram(_one_horizon(spark, folder))


@query
def scale_up(spark, folder):
    return reports.scale_up(_one_horizon(spark, folder), 0.025)


# --- predictions ------------------------------------------------------------------

LAST_WEEK = END_DATE - timedelta(days=3)
FIRST_RUN, SECOND_RUN = datetime(2001, 8, 2, 6), datetime(2001, 8, 2, 9)


@query
def household_kpis(spark, folder):
    _, rows = _household_weeks(spark, folder)
    return pred.with_recency(pred.household_kpis(rows, LAST_WEEK, P.n_weeks_stats), P.n_weeks_churn)


def _churn_output(spark, folder):
    """Predictions with closed-form parameters: the mean gap between active weeks."""
    t, all_rows = _household_weeks(spark, folder)
    rows = sampling.prediction_subset(all_rows, P)
    lookup = staged(feat.region_lookup(rows), "regions")
    inputs = feat.household_features(rows, lookup, P.default_region)
    current = fitting.current_segments(inputs, seq.read_axis(rows))
    n, steps = F.col("n_events"), F.col("n_steps")
    scored = current.withColumns(
        {"alpha": F.round(steps / n, 6), "beta": F.round(0.75 + n / (n + 8), 6)}
    )
    kpis = pred.household_kpis(all_rows, LAST_WEEK, P.n_weeks_stats)
    return t, pred.churn_output(scored, kpis, P.n_weeks_churn, "gap-rule", END_DATE)


@query
def churn_output(spark, folder):
    rows = _churn_output(spark, folder)[1].drop("table_update_dt")
    return rounded(rows, 6, "churn_probability")


def _two_runs(spark, folder):
    """All households in a first run; overdue ones again in a second, with new parameters."""
    t, rows = _churn_output(spark, folder)
    rows = staged(rows, "churn")
    again = rows.where("weeks_until_churned = 0").withColumn("alpha", F.col("alpha") + 1)
    return t, rows.withColumn("table_update_dt", F.lit(FIRST_RUN)).unionByName(
        again.withColumn("table_update_dt", F.lit(SECOND_RUN))
    )


@query
def latest_prediction(spark, folder):
    rows = pred.latest_predictions(_two_runs(spark, folder)[1])
    return rows.select("hhn", "max_week_ending_date", "prediction_date", "alpha", "table_update_dt")


# --- gold tables --------------------------------------------------------------------


def _gold_sources(t):
    return (
        src.gold_sales(t.retail_sale), src.gold_customers(t.dim_customer),
        src.gold_items(t.dim_product),
    )


def _stored_sales(sales, first_week, years):
    """Lines of the look-back windows of ``first_week`` to ``LAST_WEEK``, joined from the star schema once and stored."""
    first = gold.lookback_start(first_week, years) - timedelta(days=6)
    return staged(sales.where(F.col("fiscal_date").between(F.lit(first), F.lit(LAST_WEEK))), "sales")


def _annualized(t, years=2, week=LAST_WEEK, sales=None):
    all_sales, customers, items = _gold_sources(t)
    sales = all_sales if sales is None else sales
    return gold.annualized_sales(
        sales, customers, items, t.dim_date, week, P.excluded_card_types, years, P.period_weeks
    )


@query
def base_tenure(spark, folder):
    t = src.sales_tables(spark, folder)
    sales, customers, _ = _gold_sources(t)
    return gold.base_tenure(sales, customers, t.dim_date, LAST_WEEK, P.lookback_years, P.period_weeks)


@query
def annualized_sales(spark, folder):
    return _annualized(src.sales_tables(spark, folder))


@query
def rolling_sales(spark, folder):
    """Two successive weeks of a one-year window, built two weeks earlier and moved on by one week of lines a step."""
    t = src.sales_tables(spark, folder)
    sales, customers, items = _gold_sources(t)
    sales = _stored_sales(sales, LAST_WEEK - timedelta(weeks=3), 1)
    path = new_staging_path(spark, "rolling-sales")
    for back in (3, 2, 1, 0):
        rolling.advance_stored(path, sales, items, t.dim_date, LAST_WEEK - timedelta(weeks=back), 1)
    now, before = (
        rolling.annualized_from_window(
            rolling.stored_window(path, sales, week), customers, week, P.excluded_card_types, P.period_weeks
        ) for week in (LAST_WEEK, LAST_WEEK - timedelta(weeks=1))
    )
    return now.unionAll(before)


def _household_churn(spark, folder):
    t, runs = _two_runs(spark, folder)
    return t, gold.household_churn(_annualized(t), pred.latest_predictions(runs))


@query
def household_churn(spark, folder):
    return _household_churn(spark, folder)[1]


# --- sinks ----------------------------------------------------------------------------


@query
def merge_annualized_sales(spark, folder):
    """A one-year table merged with its two-year successor."""
    t = src.sales_tables(spark, folder)
    path = new_staging_path(spark, "annualized")
    part = "churn_max_week_ending_date"
    for years in (1, 2):
        sinks.merge_into(path, _annualized(t, years), part, **gold.ANNUALIZED_MERGE)
    return spark.read.parquet(path)


@query
def merge_household_churn(spark, folder):
    """First the overdue households with other values, then everyone."""
    _, rows = _household_churn(spark, folder)
    rows = staged(rows, "churn")
    path = new_staging_path(spark, "household-churn")
    early = rows.where("churn_segment = 'Churned'").withColumns(
        {"annualized_sales": F.col("annualized_sales") + 1, "weeks_since_last_shop": F.lit(0).cast("short")}
    )
    for source in (early, rows):
        sinks.merge_into(path, source, "max_week_ending_date", **gold.CHURN_MERGE)
    return spark.read.parquet(path)


@query
def partition_overwrite(spark, folder):
    """Two weeks are stored; then only the newer one is written again."""
    t = src.sales_tables(spark, folder)
    path = new_staging_path(spark, "overwrite")
    part = "churn_max_week_ending_date"
    both = _annualized(t, 1).unionByName(_annualized(t, 1, LAST_WEEK - timedelta(days=7)))
    sinks.overwrite(both, path, part)
    again = staged(_annualized(t, 2), "again")
    quality.require_single_value(again, part)
    sinks.overwrite_partitions(again, path, part)
    return spark.read.parquet(path)


def _versions(spark, folder):
    t = src.sales_tables(spark, folder)
    table = VersionedTable(spark, new_staging_path(spark, "versions"))
    sales = _stored_sales(_gold_sources(t)[0], LAST_WEEK, 2)
    for years, at in ((1, datetime(2001, 6, 1)), (2, datetime(2001, 7, 15)), (1, datetime(2001, 8, 1))):
        table.write(_annualized(t, years, sales=sales), at=at)
    return table


@query
def read_as_of(spark, folder):
    table = _versions(spark, folder)
    by_version = table.read_as_of(version=0).withColumn("pinned", F.lit("version"))
    by_time = table.read_as_of(timestamp=datetime(2001, 7, 20)).withColumn("pinned", F.lit("time"))
    return by_version.unionByName(by_time)


@query
def table_history(spark, folder):
    table = _versions(spark, folder)
    now = datetime(2001, 8, 10)
    days = table.last_operation(now).select("days_since").scalar()
    table.expire(SHORT_HISTORY, now)
    kept = table.history().select("version", "committed_at", "operation")
    rows = table.read_as_of().agg(F.count(F.lit(1)).alias("n_live_rows"))
    return kept.withColumns({"days_since": days, "n_live_rows": rows.scalar()})


# --- quality --------------------------------------------------------------------------


@query
def quality_report(spark, folder):
    t, rows = _household_weeks(spark, folder)
    return quality.check_household_weeks(rows, P)


@query
def quality_customer_weeks(spark, folder):
    return quality.check_customer_weeks(_customer_weeks(spark, folder)[2], P)


@query
def quality_churn_output(spark, folder):
    return quality.check_churn_output(_churn_output(spark, folder)[1], P)


@query
def quality_household_churn(spark, folder):
    t, rows = _household_churn(spark, folder)
    return quality.check_household_churn(rows, t.dim_date, P, HOUSEHOLD_CHURN_COLUMNS)


@query
def low_weeks_except_holiday(spark, folder):
    t, rows = _household_weeks(spark, folder)
    weekly_rows = rows.withColumnRenamed("week_ending_date", "max_week_ending_date")
    return quality.low_weeks_except_holiday(weekly_rows, t.dim_date, 40)


# --- everything -------------------------------------------------------------------------


@query
def retention_flow(spark, folder):
    tables = src.sales_tables(spark, folder)
    flow = RetentionFlow(spark, tables, new_staging_path(spark, "flow"), P)
    return rounded(flow.run(*_gold_sources(tables), prediction_date=END_DATE), 3,
                   "churn_probability", "next_week_shop_prob")
