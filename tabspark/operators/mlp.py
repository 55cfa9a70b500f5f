"""MLP classifier on Spark (ML1-ML13).

Training (``MlpClassifier.fit``) is synchronous local SGD with model
averaging: per epoch ONE ``mapInArrow`` job over the epoch's mini-batches
(``operators.minibatch``: a global shuffle), in which every task streams its batches,
starting from the broadcast weights. The weights and optimizer moments come
back as one vector a task, added up by a tree of two levels; the driver only
receives one model-sized vector. With a single partition this is exactly the
reference's sequential mini-batch training. Validation is a second job that
folds loss and confusion counts per partition. A bank of runs (``tuning``) shares
both jobs.

Scoring (``MlpModel.transform``) is a scalar pandas UDF over the feature
columns only (Arrow batches, NumPy matmuls, weights broadcast); every other
column stays on the JVM.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.operators import mlp_math as MM
from tabspark.operators.minibatch import VECTORS, batch_count, in_batches, numbered, vector_sums
from tabspark.operators.mlp_math import MlpParams
from tabspark.functions import sqltext as Q
from tabspark.schema import col
from tabspark.session import local_frame, path_exists

def _score_type(k: int) -> T.StructType:
    """Scalar columns only: arrays are assembled on the JVM (per-row Python
    lists would dominate the cost of the UDF)."""
    return T.StructType([T.StructField(f"z{j}", T.DoubleType()) for j in range(k)]
                        + [T.StructField(f"p{j}", T.DoubleType()) for j in range(k)]
                        + [T.StructField("prediction", T.IntegerType()),
                           T.StructField("confidence", T.DoubleType())])


def _score_fn(params: MlpParams, bc):
    k = params.num_classes

    def score(*cols: pd.Series) -> pd.DataFrame:
        w = bc.value
        x = np.column_stack([c.to_numpy(dtype=np.float32, na_value=np.nan) for c in cols]).astype(np.float64)
        logits = MM.predict_logits(params, w, x)
        prob = MM.softmax_np(logits)
        out = {f"z{j}": logits[:, j] for j in range(k)}
        out.update({f"p{j}": prob[:, j] for j in range(k)})
        out["prediction"] = prob.argmax(axis=1).astype(np.int32)
        out["confidence"] = prob.max(axis=1)
        return pd.DataFrame(out)
    return score


@dataclass
class MlpModel:
    params: MlpParams
    weights: dict
    features: list[str]
    _bc: object = field(default=None, repr=False, compare=False)

    def _broadcast(self, spark: SparkSession):
        # model-sized (a few thousand doubles): bounded regardless of data size
        if self._bc is None:
            self._bc = spark.sparkContext.broadcast(self.weights)
        return self._bc

    def score_column(self, spark: SparkSession) -> Column:
        udf = F.pandas_udf(_score_fn(self.params, self._broadcast(spark)), _score_type(self.params.num_classes))
        return udf(*[F.expr(f"CAST({Q.ident(f)} AS FLOAT)") for f in self.features])

    def transform(self, df: DataFrame, output: str = "predictions") -> DataFrame:
        """Adds logits, probabilities, prediction, is_defect, defect_probability,
        confidence (ML9) or ``logits`` only (ML11)."""
        k = self.params.num_classes
        s = df.withColumn("__s", self.score_column(df.sparkSession))
        # arrays are assembled on the JVM from the UDF's scalar fields
        logits = "array(" + ", ".join(f"__s.z{j}" for j in range(k)) + ") AS logits"
        keep = [Q.ident(c) for c in df.columns]
        if output == "logits":
            return s.selectExpr(*keep, logits)
        pos = "__s.p1" if k > 1 else "__s.p0"
        return s.selectExpr(*keep, logits,
                            "array(" + ", ".join(f"__s.p{j}" for j in range(k)) + ") AS probabilities",
                            "__s.prediction AS prediction", "(__s.prediction = 1) AS is_defect",
                            f"{pos} AS defect_probability", "__s.confidence AS confidence")

    # -------------------------------------------------------------- persistence
    def write(self, spark: SparkSession, path: str) -> None:
        rows = [(name, list(shape), [float(v) for v in np.asarray(self.weights[name]).ravel()])
                for name, shape, _ in MM.param_shapes(self.params)]
        (spark.createDataFrame(rows, "name string, shape array<int>, values array<double>")
         .coalesce(1).write.mode("overwrite").parquet(f"{path}/weights"))
        meta = json.dumps({"params": asdict(self.params), "features": self.features})
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> "MlpModel":
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        params = MlpParams(**meta["params"])
        w = {r["name"]: np.asarray(r["values"], dtype=np.float64).reshape(r["shape"])
             for r in spark.read.parquet(f"{path}/weights").collect()}  # one row per tensor
        return cls(params, w, meta["features"])


# ------------------------------------------------------------------ training
STATS = 8  # rows, steps x rows, loss sum, rows seen, confusion counts (tp, fp, tn, fn); then weights, both moments


def _arrays(batch, k: int):
    """(features, label) of an Arrow batch, a row a feature."""
    x = np.empty((k, batch.num_rows))
    for i in range(k):
        x[i] = batch.column(f"x{i}").to_numpy(zero_copy_only=False)  # null: NaN
    return x, batch.column("y").to_numpy(zero_copy_only=False).astype(np.int64)


def _batches(it, k: int):
    """(x, y) of each mini-batch of a stream of rows sorted by mini-batch; no more than one is kept back."""
    kept = None
    for rows in it:
        if not rows.num_rows:
            continue
        now = (*_arrays(rows, k), rows.column("__b").to_numpy())
        x, y, b = now if kept is None else (np.concatenate(c, axis=-1) for c in zip(kept, now))
        cuts = [0, *(np.flatnonzero(b[1:] != b[:-1]) + 1).tolist()]
        for i, j in zip(cuts, cuts[1:]):
            yield x[:, i:j].copy().T, y[i:j]
        kept = x[:, cuts[-1]:], y[cuts[-1]:], b[cuts[-1]:]
    if kept is not None:
        yield kept[0].copy().T, kept[1]


def _train_epoch_fn(bc, k: int):
    """mapInArrow function: trains every run of the bank on the task's batches; one vector a run."""
    def run(it):
        import pyarrow as pa
        from pyspark import TaskContext
        bank, alpha, epoch = bc.value
        pid = TaskContext.get().partitionId()
        live = [(i, p, MM.Learner(p, w, m, v, t), MM.lr_at(p, epoch), np.random.default_rng([p.seed, epoch, pid]), np.zeros(STATS))
                for i, p, w, m, v, t in bank]
        for x, y in _batches(it, k):
            for _, _, learner, lr, rng, stats in live:
                if (got := learner.step(x, y, lr, alpha, rng)) is not None:
                    stats += [len(y), 1, got[0], len(y), *got[1]]
        for i, p, learner, _, _, stats in live:
            if stats[0]:
                wt = stats[0]
                stats[1] *= wt
                vec = np.concatenate([stats, *(MM.flatten(p, d) * wt for d in (learner.w, learner.m, learner.v))])
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([pid], pa.int32()),
                                                  pa.array([vec], pa.list_(pa.float64()))], names=["run", "part", "vec"])
    return run


def _eval_fn(bc, k: int):
    """mapInArrow function: loss and confusion counts of every run of the bank over the task's rows."""
    def run(it):
        import pyarrow as pa
        bank, alpha = bc.value
        acc = {i: np.zeros(6) for i, *_ in bank}
        for rows in it:
            if not rows.num_rows:
                continue
            x, y = _arrays(rows, k)
            for i, p, w in bank:
                logits = MM.predict_logits(p, w, x.T)
                loss, _ = MM.loss_and_grad(p, logits, y, alpha)
                if p.use_focal_loss:
                    num, den = loss * len(y), len(y)
                else:
                    den = float(alpha[y].sum())
                    num = loss * den
                pred = logits.argmax(axis=1)
                acc[i] += [num, den, ((y == 1) & (pred == 1)).sum(), ((y == 0) & (pred == 1)).sum(),
                           ((y == 0) & (pred == 0)).sum(), ((y == 1) & (pred == 0)).sum()]
        for i, a in acc.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(6, i, np.int32)), pa.array(np.arange(6, dtype=np.int32)), pa.array(a)],
                                             names=["run", "idx", "val"])
    return run


def _prf(tp, fp, tn, fn):
    tot = tp + fp + tn + fn
    acc = (tp + tn) / tot if tot else 0.0
    prec = tp / (tp + fp) if tp + fp else 0.0
    rec = tp / (tp + fn) if tp + fn else 0.0
    f1 = 2 * tp / (2 * tp + fp + fn) if (2 * tp + fp + fn) else 0.0
    return acc, prec, rec, f1


@dataclass
class FitResult:
    best: MlpModel
    last: MlpModel
    history: DataFrame
    best_epoch: int
    stopped_epoch: int | None
    class_weights: list[float]
    steps: list[tuple[int, int, int]] = field(default_factory=list)  # (epoch, rows seen, mini-batches)


def _model_frame(df: DataFrame, features: list[str], label: str) -> DataFrame:
    # float32 at the model edge
    return df.selectExpr(*[f"CAST({Q.ident(f)} AS FLOAT) AS x{i}" for i, f in enumerate(features)],
                         f"CAST({Q.ident(label)} AS INT) AS y").where("y IS NOT NULL")


#: Rows of a training task, which streams them batch by batch.
PARTITION_ROWS = 65_536


def partitions_for(train: DataFrame) -> int:
    """Tasks for the counted rows, at most about ``PARTITION_ROWS`` each."""
    return max(1, -(-train.count() // PARTITION_ROWS))


class Run:
    """The state of one fit between epochs."""

    def __init__(self, params: MlpParams, run_id: str):
        self.p, self.run_id = params, run_id
        self.w = MM.init_weights(params)
        self.m, self.v = ({n: np.zeros_like(a) for n, a in self.w.items()} for _ in range(2))
        self.t, self.epoch, self.wait = 0, 0, 0
        self.rows, self.steps = [], []
        self.best_score, self.best_w, self.best_epoch, self.stopped = -np.inf, None, -1, None

    @property
    def over(self) -> bool:
        return self.stopped is not None or self.epoch >= self.p.max_epochs

    def learned(self, vec: np.ndarray | None) -> np.ndarray:
        """Takes over the summed parts of an epoch; returns their statistics."""
        if vec is None:
            return np.zeros(STATS)
        size, wt = len(MM.flatten(self.p, self.w)), vec[0]
        self.w, self.m, self.v = (MM.unflatten(self.p, vec[STATS + j * size: STATS + (j + 1) * size] / wt) for j in range(3))
        steps = int(round(vec[1] / wt))  # of a task, on average
        self.t += steps
        return vec[:STATS]

    def scored(self, stats: np.ndarray, batches: int, e: np.ndarray, on_epoch=None) -> dict:
        """Closes an epoch: history, best checkpoint (strictly better val_f1, ties keep the first), early stop."""
        names = ("loss", "accuracy", "precision", "recall", "f1")
        train = [stats[2] / stats[3] if stats[3] else float("nan"), *_prf(*stats[4:8])]
        val = [e[0] / e[1] if e[1] else float("nan"), *_prf(*e[2:6])]
        metrics = {"lr": MM.lr_at(self.p, self.epoch), **{f"train_{n}": x for n, x in zip(names, train)}, **{f"val_{n}": x for n, x in zip(names, val)}}
        self.rows += [(self.run_id, self.epoch, name, float(x)) for name, x in metrics.items()]
        self.steps.append((self.epoch, int(stats[3]), batches if stats[3] else 0))
        ended = on_epoch is not None and on_epoch(self.epoch, metrics)  # pruned by the caller
        if metrics["val_f1"] > self.best_score:
            self.best_score, self.best_w, self.best_epoch, self.wait = metrics["val_f1"], {n: a.copy() for n, a in self.w.items()}, self.epoch, 0
        else:
            self.wait += 1
        if ended or self.wait >= self.p.patience:
            self.stopped = self.epoch
        self.epoch += 1
        return metrics

    def save(self, spark: SparkSession, path: str) -> None:
        _save_state(spark, path, self.run_id, self.epoch - 1, {"w": self.w, "m": self.m, "v": self.v, "best": self.best_w or {}},
                    {"t": self.t, "best_score": self.best_score, "best_ep": self.best_epoch, "wait": self.wait, "history": self.rows,
                     "steps": self.steps, "epoch": self.epoch - 1, "stopped": self.stopped})

    def load(self, spark: SparkSession, path: str) -> None:
        """The last committed epoch of this run, if there is one."""
        if (state := _load_state(spark, path, self.run_id)) is None:
            return
        tensors, meta = state
        self.w, self.m, self.v, self.best_w = tensors["w"], tensors["m"], tensors["v"], tensors.get("best") or None
        self.t, self.best_score, self.best_epoch, self.wait = meta["t"], meta["best_score"], meta["best_ep"], meta["wait"]
        self.rows, self.steps = [tuple(r) for r in meta["history"]], [tuple(r) for r in meta.get("steps", [])]
        self.epoch, self.stopped = meta["epoch"] + 1, meta["stopped"]


class Trainer:
    """Checkpointed training and validation rows, and one job an epoch for all runs of a bank."""

    def __init__(self, train: DataFrame, val: DataFrame, features: list[str], label: str, num_partitions: int | None = None,
                 num_classes: int = 2):
        from tabspark.operators.metrics import class_weight_list
        self.spark, self.k = train.sparkSession, len(features)
        # cut lineage: each epoch re-reads the same rows under the same numbers,
        # also after an executor loss (reliable checkpoint in spark.checkpoint.dir)
        tr = _model_frame(train, features, label).checkpoint(eager=True)
        self.val = _model_frame(val, features, label).checkpoint(eager=True)
        self.train, self.n = numbered(tr)
        self.parts = num_partitions or partitions_for(tr)
        self.alpha = np.asarray(class_weight_list(tr, "y", num_classes), dtype=np.float64)

    def epoch(self, runs: list[Run], on_epoch=None) -> None:
        """One epoch of every run (all at the same epoch): a training job for each way of cutting batches, and a validation job."""
        sc, epoch = self.spark.sparkContext, runs[0].epoch
        ways: dict = {}
        for i, r in enumerate(runs):
            ways.setdefault((r.p.batch_size, r.p.seed, r.p.drop_last), []).append(i)
        stats, batches = {}, {}
        for (size, seed, drop_last), members in ways.items():
            sums = {}
            if self.n:
                bc = sc.broadcast(([(i, runs[i].p, runs[i].w, runs[i].m, runs[i].v, runs[i].t) for i in members], self.alpha, epoch))  # model-sized
                d = in_batches(self.train, self.n, size, seed, epoch, drop_last, self.parts)
                sums = vector_sums(d.mapInArrow(_train_epoch_fn(bc, self.k), VECTORS), self.parts)
                bc.unpersist()
            for i in members:
                stats[i], batches[i] = runs[i].learned(sums.get(i)), batch_count(self.n, size, drop_last)
        bc = sc.broadcast(([(i, r.p, r.w) for i, r in enumerate(runs)], self.alpha))
        ev = self.val.mapInArrow(_eval_fn(bc, self.k), "run int, idx int, val double").groupBy("run", "idx").agg(F.sum("val").alias("val")).collect()
        bc.unpersist()
        e = np.zeros((len(runs), 6))
        for r in ev:
            e[r["run"], r["idx"]] = r["val"]
        for i, r in enumerate(runs):
            r.scored(stats[i], batches[i], e[i], on_epoch)


class MlpClassifier:
    def __init__(self, params: MlpParams | None = None, features: list[str] | None = None,
                 label: str = "label", num_partitions: int | None = None, run_id: str = "run"):
        self.params = params or MlpParams()
        self.features = features
        self.label = label
        self.num_partitions = num_partitions
        self.run_id = run_id

    def fit(self, train: DataFrame, val: DataFrame, on_epoch=None, resume_dir: str | None = None) -> FitResult:
        """Distributed fit. With ``resume_dir`` (shared storage), the complete
        training state is appended there after every epoch and a restarted fit
        continues after the last committed epoch (same result: every step is
        deterministic for a fixed partitioning)."""
        trainer = Trainer(train, val, self.features, self.label, self.num_partitions, self.params.num_classes)
        run = Run(self.params.replace(input_size=len(self.features)), self.run_id)
        if resume_dir:
            run.load(trainer.spark, resume_dir)
        while not run.over:
            trainer.epoch([run], on_epoch)
            if resume_dir:
                run.save(trainer.spark, resume_dir)
        return result_of(run, trainer, self.features)


def result_of(run: Run, trainer: Trainer, features: list[str]) -> FitResult:
    history = local_frame(trainer.spark, run.rows, "run_id string, epoch int, metric string, value double")
    return FitResult(MlpModel(run.p, run.best_w if run.best_w is not None else run.w, features), MlpModel(run.p, run.w, features),
                     history, run.best_epoch, run.stopped, [float(a) for a in trainer.alpha], run.steps)


def _save_state(spark: SparkSession, path: str, run_id: str, epoch: int, tensors: dict, meta: dict) -> None:
    """Appends one epoch's training state as parquet rows (model-sized)."""
    rows = [(kind, name, list(np.shape(a)), [float(x) for x in np.asarray(a).ravel()], None)
            for kind, d in tensors.items() for name, a in d.items()]
    rows.append(("meta", "", [], [], json.dumps(meta)))
    df = local_frame(spark, rows, "kind string, name string, shape array<int>, values array<double>, meta string")
    (df.withColumn("run_id", F.lit(run_id)).withColumn("epoch", F.lit(epoch)).coalesce(1)
     .write.mode("append").partitionBy("run_id", "epoch").parquet(path))


def _load_state(spark: SparkSession, path: str, run_id: str):
    """The last committed epoch state of a run, or None."""
    if not path_exists(spark, path):
        return None
    df = spark.read.parquet(path).where(F.col("run_id") == run_id)
    last = df.agg(F.max("epoch")).first()[0]
    if last is None:
        return None
    tensors: dict = {}
    meta = None
    for r in df.where(F.col("epoch") == last).collect():  # one row per tensor
        if r["kind"] == "meta":
            meta = json.loads(r["meta"])
        else:
            tensors.setdefault(r["kind"], {})[r["name"]] = np.asarray(r["values"], dtype=np.float64).reshape(r["shape"])
    return tensors, meta


def fixed_model(features: list[str], params: MlpParams | None = None, seed: int = 42) -> MlpModel:
    """Untrained model with seeded Kaiming weights (deterministic scoring fixture)."""
    p = (params or MlpParams()).replace(input_size=len(features))
    return MlpModel(p, MM.init_weights(p, seed), list(features))


class PreprocessScorer:
    """Preprocess-then-score (T6): optional scaler stage, then the model."""

    def __init__(self, scaler, model: MlpModel):
        self.scaler = scaler
        self.model = model

    def transform(self, df: DataFrame, output: str = "predictions") -> DataFrame:
        x = self.scaler.transform(df) if self.scaler is not None else df
        return self.model.transform(x, output)


def evaluate(model_or_scorer, df: DataFrame, label: str = "label") -> DataFrame:
    """Scores and, when a label is present, accuracy/precision/recall/f1 and
    exact ROC-AUC in one row (ML10); without a label the predictions."""
    from tabspark.operators.metrics import evaluation
    scored = model_or_scorer.transform(df)
    if label not in df.columns:
        return scored
    got = evaluation(scored, label)
    return local_frame(df.sparkSession, [tuple(got[c] for c in ("accuracy", "precision", "recall", "f1", "roc_auc"))],
                       "accuracy double, precision double, recall double, f1 double, roc_auc double")
