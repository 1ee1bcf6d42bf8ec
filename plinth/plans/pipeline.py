"""Composed jobs: preprocessing, training and ensembling.

Each stage is a function over the (train, test) pair; after each stage the pair
is written as Parquet under a run folder in the shared checkpoint location (this
cuts the lineage, like the reference's CSV hand-over), a gate of data checks is
enforced, and a manifest names the stage, so that a run can be resumed.  Column names follow the order-facts analogue.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.operators import clean, cluster, encode, features as fe, folds, groupfeat, quality as qa
from plinth.operators import select as se, shape, target_encode as te
from plinth.sources import files as fs
from plinth.sources.commit_log import CommitLog

KEY, TARGET = "okey", "y"


#: Checks that are reported but stop nothing.
WARNINGS = ("outliers_5sigma", "predictions_in_range")


def gate(train: DataFrame, test: DataFrame, stage: int, before: tuple[DataFrame, DataFrame] | None = None,
         stop_on_error: bool = True) -> DataFrame:
    """M14 after a stage, raising on failure: key overlap, missing values, row counts (stage 2 may drop train
    rows), equal columns, a known target that test does not have; from stage 2 correlations with the target,
    from stage 4 the sanity of the features.  Checks in ``WARNINGS`` are only reported."""
    num = [c for c in clean.numeric_columns(train, exclude=(KEY, TARGET)) if c in test.columns]
    uneven = sorted(set(train.columns) - {TARGET} ^ set(test.columns))
    checks = [qa.train_test_overlap(train, test, KEY, TARGET), qa.null_counts(train, num), qa.null_counts(test, num),
              qa.null_counts(train, [TARGET], "target_known"), _fact(train.sparkSession, "equal_columns", not uneven, ",".join(uneven))]
    if before is not None:
        checks += [qa.row_count_consistency(before[0], train, stage == 2), qa.row_count_consistency(before[1], test)]
    if stage >= 2:
        checks.append(qa.leakage_correlation(train, TARGET, [c for c in num if c != "custkey"], test))
    warnings = []
    if stage >= 4:
        sanity = qa.feature_sanity(train, num)
        checks.append(sanity.where(~F.col("check").isin(*WARNINGS)))
        warnings.append(sanity.where(F.col("check").isin(*WARNINGS)))
    result = qa.stage_gate(checks, f"stage{stage}")
    if stop_on_error:
        qa.raise_on_failure(result.where(F.col("check") != "stage_gate"), leakage_checks=("key_overlap", "leakage_corr"))
    return functools.reduce(DataFrame.unionByName, warnings, result)


def _fact(spark: SparkSession, check: str, passed: bool, detail: str) -> DataFrame:
    return spark.createDataFrame([(check, None, passed, detail)], "check string, column string, passed boolean, detail string")


class Stages:
    """Stage tables under the fingerprint of everything they depend on: the input, the stages before and the settings.

    A stage is written, checked and then named by the commit log ``manifest``; a run that was killed, or whose
    check failed, starts again at the first stage that the manifest does not name.  Without ``input_id`` every
    run has an input of its own and none is resumed.
    """

    def __init__(self, spark: SparkSession, base: str, input_id: str | None = None):
        self.spark, self.base = spark, base.rstrip("/")
        self.mark = input_id or uuid.uuid4().hex
        self.manifest = CommitLog(spark, f"{self.base}/manifest", fmt="json")
        self.ran: list[int] = []

    def run(self, stages: Sequence[tuple], start: tuple, check: Callable = gate) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
        """Run ``stages`` of (number, settings, function of train and test); the last pair and all gate tables."""
        marks = list(itertools.accumulate(
            stages, lambda m, st: hashlib.sha256(json.dumps([m, st[0], st[1]], sort_keys=True).encode()).hexdigest()[:24], initial=self.mark))[1:]
        done = {c.get("txn") for c in self.manifest.commits()}
        first = next((i for i, m in enumerate(marks) if m not in done), len(stages))
        pair = fs.load_pair(self.spark, self._folder(marks[first - 1]), stages[first - 1][0]) if first else start
        for i in range(first, len(stages)):
            number, settings, step = stages[i]
            folder = self._folder(marks[i])
            after = step(*pair)
            for part, train in zip(after, (True, False)):
                fs.save_stage(part, folder, number, train)
            after = fs.load_pair(self.spark, folder, number)
            check(*after, number, pair if i else None).coalesce(1).write.mode("overwrite").parquet(f"{folder}/gate")
            row = self.spark.createDataFrame([(number, marks[i], json.dumps(settings, sort_keys=True))], "stage int, fingerprint string, settings string")
            self.manifest.append(row, txn=marks[i])
            self.ran.append(number)
            pair = after
        return *pair, [self.spark.read.parquet(f"{self._folder(m)}/gate") for m in marks]

    def _folder(self, mark: str) -> str:
        return f"{self.base}/{mark}"


def preprocess(spark: SparkSession, facts: DataFrame, base: str, feature_engineering: bool = True,
               select_percentile: float = 10.0, input_id: str | None = None) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """P01 (and P02 with ``feature_engineering=False``): stages 1-8 with a gate after each; see :class:`Stages`."""
    steps = [(1, {}, _clean), (2, {}, _derive), (3, {}, _unskew)]
    if feature_engineering:
        steps.append((4, {}, _engineer))
    steps += [(5, {}, _scale), (6, {"max_levels": 10}, lambda tr, ts: encode.one_hot_encode(tr, ts, 10, exclude=(KEY,))),
              (7, {"percentile": select_percentile}, lambda tr, ts: _select(tr, ts, select_percentile)), (8, {"folds": 5}, _encode)]
    return Stages(spark, base, input_id).run(steps, (facts, facts))


def _clean(facts: DataFrame, _: DataFrame) -> tuple[DataFrame, DataFrame]:
    f = clean.fill_missing(facts.drop("first_ship"), exclude=(KEY, "custkey", "is_train"))
    return f.where("is_train").drop("is_train"), f.where("NOT is_train").drop("is_train", TARGET)


def _derive(tr: DataFrame, ts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The outlier rule (train only), ages and totals."""
    tr = clean.remove_outliers(tr, (F.col("sum_qty") > 250) & (F.col(TARGET) < 10), train_flag=None)
    derive = [*fe.age_features("ship_year", {"Age": "order_year"}), fe.null_safe_sum("TotalUnits", {"sum_qty": 1, "n_lines": 0.5})]
    return fe.with_columns(tr, derive), fe.with_columns(ts, derive)


def _continuous(tr: DataFrame) -> list[str]:
    return encode.continuous_columns(tr, 0.05, exclude=(KEY, "custkey", TARGET))


def _unskew(tr: DataFrame, ts: DataFrame) -> tuple[DataFrame, DataFrame]:
    return shape.unskew(tr, ts, _continuous(tr), exclude=(TARGET,))[:2]


def _scale(tr: DataFrame, ts: DataFrame) -> tuple[DataFrame, DataFrame]:
    params = encode.fit_standard_scaler(tr, _continuous(tr))
    return encode.apply_standard_scaler(tr, params), encode.apply_standard_scaler(ts, params)


def _select(tr: DataFrame, ts: DataFrame, percentile: float) -> tuple[DataFrame, DataFrame]:
    """Correlation and lasso scores combined; text columns always stay."""
    num = [c for c in clean.numeric_columns(tr, exclude=(KEY, "custkey", TARGET)) if c in ts.columns]
    text = [c for c in clean.text_columns(tr) if c in ts.columns]
    chosen = se.select_features(folds.kfold(tr, KEY, 5, 42), TARGET, num, categorical=text, percentile=percentile,
                                score_methods=("correlation", "lasso"))
    keep = [r["feature"] for r in chosen.collect()]  # feature names only
    return tr.select(KEY, TARGET, *[c for c in keep if c in tr.columns]), ts.select(KEY, *[c for c in keep if c in ts.columns])


def _encode(tr: DataFrame, ts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Out-of-fold target encoding, then numeric columns only."""
    tr = folds.kfold(tr, KEY, 5, 42)
    cats = [c for c in clean.text_columns(tr) if c in ts.columns]
    tr, ts = te.encode_many(tr, ts, cats, TARGET)
    if "nation" in tr.columns:
        tr, ts = te.oof_group_stats(tr, ts, "nation", TARGET, 5)
    return clean.keep_numeric(tr.drop("fold")), clean.keep_numeric(ts)


def _engineer(tr: DataFrame, ts: DataFrame) -> tuple[DataFrame, DataFrame]:
    specs_common = [fe.decade("order_year"),
                    *fe.presence_flags(tr, {"HasLines": "n_lines", "HasDiscount": "avg_disc"}),
                    fe.equality_flag(tr, "IsUrgent", "priority", "1-URGENT"),
                    *fe.squares(tr, ["sum_qty", "n_lines"]),
                    *fe.ratios_plus_one([("price_per_qty", "sum_price", "sum_qty")], tr)]
    tr, ts = fe.with_columns(tr, specs_common), fe.with_columns(ts, specs_common)
    tr, ts = groupfeat.group_benchmarks(tr, [tr, ts], [("nation", "sum_qty", "median"), ("nation", "Age", "median")])
    tr, ts = cluster.kmeans_feature(tr, ts, ["n_lines", "sum_qty", "sum_price"], k=4)
    return tr, ts


def train_and_submit(spark: SparkSession, train: DataFrame, test: DataFrame, features: Sequence[str], base: str,
                     model: str | Callable = "ridge", alpha: float = 10.0,
                     name: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Input gate -> folds -> CV score -> refit on all rows -> predict -> prediction and submission gates ->
    write the submission -> commit the run to the log.

    ``model`` is a linear kind, a tree kind or an estimator factory.  A failed gate raises before anything is
    written.  Returns (submission, run log, prediction and submission checks)."""
    from plinth.operators import models as mo, runlog as rl

    name = name or (model if isinstance(model, str) else "custom")
    qa.raise_on_failure(qa.model_input_gate(train, test, KEY, TARGET, features))
    tr = folds.stratified_kfold(train, KEY, TARGET, 5, 10, 42).withColumn("label", F.col(TARGET))
    data = mo.assemble(tr, features).select("features", "label", "fold").persist()
    if callable(model):
        factory, settings = model, {}
    elif model in ("ridge", "lasso", "elasticnet", "ols"):
        factory, settings = mo.linear_factory(model, alpha), {"alpha": alpha}
    else:
        factory, settings = (lambda: mo.make_tree(model)), {}
    mean, _ = mo.cv_rmse(data, factory, "fold")
    fitted = mo._estimator(factory, data).fit(data)
    data.unpersist()
    pred = fitted.transform(mo.assemble(test, features)).select(KEY, F.col("prediction").alias("pred"))
    sane = qa.prediction_sanity(pred, "pred", log_space=True)
    qa.raise_on_failure(sane.where(~F.col("check").isin(*WARNINGS)))
    sub = fs.create_submission(pred, test.select(KEY), key=KEY)
    formed = qa.submission_format(sub, test.select(F.col(KEY).alias("Id")), "Id", "SalePrice")
    qa.raise_on_failure(formed)
    base = base.rstrip("/")
    fs.write_submission(sub, f"{base}/submission_{name}")
    run = spark.createDataFrame([(name, float(mean), json.dumps(settings), len(features))],
                                "model string, rmse double, hyperparams string, feat_count int") \
        .withColumn("timestamp", F.current_timestamp()) \
        .withColumn("feat_hash", rl.feature_hash(F.array(*[F.lit(f) for f in features])))
    log = CommitLog(spark, f"{base}/run_log")
    log.append(run)
    return sub, log.read(), sane.unionByName(formed)


def ensemble(spark: SparkSession, train: DataFrame, test: DataFrame, features: Sequence[str],
             method: str = "stack") -> DataFrame:
    """OOF predictions of base models -> ridge meta-model (``stack``) or simplex blend
    weights (``blend``) -> bounded price predictions."""
    from plinth.operators import ensemble as ens, models as mo

    tr = folds.stratified_kfold(train, KEY, TARGET, 5, 10, 42).withColumn("label", F.col(TARGET))
    bases = {"ridge": mo.linear_factory("ridge", 10.0), "lasso": mo.linear_factory("lasso", 1e-3)}
    oof, tst = ens.oof_predictions(mo.assemble(tr, features).select(KEY, "fold", "features", "label"), bases, KEY, "fold", mo.assemble(test, features))
    oof = oof.join(tr.select(KEY, TARGET), KEY)
    if method == "stack":
        _, pred = ens.stack_meta(oof, tst, list(bases), TARGET, KEY, alpha=0.1)
        return pred
    w = ens.optimize_weights(oof, [f"pred_{m}" for m in bases], TARGET)
    expr = sum(F.col(m) * F.lit(v) for m, v in w.items())
    return tst.select(KEY, fe.bounded_inverse(expr).alias("SalePrice"))
