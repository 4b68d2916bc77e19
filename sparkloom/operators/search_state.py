"""Search state: derived arrays and termination, recovery from checkpoints, retention, fair dispatch, waves."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import shared_path

SYSTEM_REASONS = ("branch_error", "request_limit", "system_error", "timeout")


def refresh(states: DataFrame) -> DataFrame:
    """States with attempted, in_flight, status, coverage and reason recomputed from their plan.

    plan: array of (operator, branch, status); candidates, target: boundary candidates found and
    wanted; live, forced: booleans; status, coverage, reason: as they were.
    """
    names = lambda keep, field: F.filter(F.transform(F.filter("plan", keep), lambda x: x[field]), lambda x: F.coalesce(F.trim(x), F.lit("")) != "")
    s = states.withColumns({"attempted": names(lambda x: x["status"] != "pending", "operator"), "in_flight": names(lambda x: x["status"] == "running", "branch")})
    pending, idle = F.exists("plan", lambda x: x["status"] == "pending"), F.size("in_flight") == 0
    reached = ~F.col("live") & (F.col("candidates") >= F.col("target"))
    done = ~pending & idle
    reason = F.when(reached, "boundary_target_reached").when(done & F.col("forced"), "operator_space_exhausted").when(done, "candidate_list_exhausted").otherwise(F.col("reason"))
    coverage = F.when(done, "complete").when(reached, "partial").otherwise(F.col("coverage"))
    status = F.when(reached & idle, "completed").when(reached, "running").when(done, "completed").otherwise(F.col("status"))
    return s.withColumns({"reason": reason, "coverage": coverage, "status": status})


def recover(inputs: DataFrame, checkpoints: DataFrame, key: str, order: str, digest: Column, system: Sequence[str] = SYSTEM_REASONS) -> DataFrame:
    """Every input with the last checkpoint of its key: status, reason, resumed.

    checkpoints: key, order, input_digest, status, reason.  A checkpoint of another input raises; a
    partial search that the system ended runs again, one that ended by a rule stays; an input
    without a checkpoint is new.
    """
    last = checkpoints.groupBy(key).agg(F.max_by(F.struct("input_digest", "status", "reason"), order).alias("c"))
    j = inputs.withColumn("__digest", digest).join(last, key, "left")
    c = lambda x: F.col(f"c.{x}")
    matches = F.col("c").isNull() | (c("input_digest") == F.col("__digest"))
    reopened = (c("status") == "partial") & c("reason").isin(*system)
    status = F.when(~matches, F.raise_error(F.concat(F.lit("checkpoint of another input for "), F.col(key).cast("string"))).cast("string"))
    status = status.when(F.col("c").isNull(), "new").when(reopened, "running").otherwise(c("status"))
    return j.select(*inputs.columns, status.alias("status"), F.when(~reopened, c("reason")).alias("reason"), F.coalesce(reopened, F.lit(False)).alias("resumed"))


def retain_only(checkpoints: DataFrame, branch: str, stage: str, order: str, keep: Sequence[str], durable: str) -> DataFrame:
    """Checkpoints without those that a newer durable state replaces: of a branch that has the stage `durable`, only the stages in `keep`, each at its latest."""
    has = checkpoints.groupBy(branch).agg(F.max(F.col(stage) == durable).alias("__durable"), F.max_by(stage, order).alias("__last"))
    latest = checkpoints.groupBy(branch, stage).agg(F.max_by(F.struct(*checkpoints.columns), order).alias("r")).select("r.*")
    return latest.join(has, branch).filter(~F.col("__durable") | F.col(stage).isin(*keep)).drop("__durable", "__last")


def fair_waves(requests: DataFrame, sample: str, order: str, limit: int) -> DataFrame:
    """requests with `turn` and `wave`: samples take turns, one request each, and `limit` requests run at once.

    Only the turns are counted globally, one row per turn; a turn's requests are numbered inside it.
    """
    turns = requests.withColumn("turn", F.row_number().over(Window.partitionBy(sample).orderBy(order)).cast("long"))
    sizes = turns.groupBy("turn").agg(F.count("*").alias("n"))
    sizes = sizes.select("turn", F.coalesce(F.sum("n").over(Window.orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("turn").orderBy(sample)) + F.col("before")
    return turns.join(sizes, "turn").withColumn("wave", F.floor((place - 1) / limit).cast("long")).drop("before")


def bounded_map(records: DataFrame, worker: Callable, schema: str, concurrency: int, key: str | None = None) -> DataFrame:
    """worker over Arrow-backed frames of records, at most `concurrency` of them at once; records of a key share a worker.

    Results keep no order; carry an order column and sort where the input's order matters.
    """
    parts = records.repartition(concurrency, key) if key else records.repartition(concurrency)
    return parts.mapInPandas(lambda frames: (worker(f) for f in frames), schema)


def run_waves(state: DataFrame, claim: Callable, step: Callable, merge: Callable, most: int) -> tuple[DataFrame, int]:
    """Claim, run and merge until nothing is claimed or `most` waves have run; a wave's state is a table in the shared folder.

    claim(state) -> rows to run; step(claimed) -> their results; merge(state, results) -> the next state.
    """
    spark, run = state.sparkSession, uuid.uuid4().hex

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = shared_path(spark, f"{name}-{run}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    state = kept(state, "wave")
    for n in range(most):
        claimed = kept(claim(state), "claimed")
        if claimed.isEmpty():
            return state, n
        state = kept(merge(state, step(claimed)), "wave")
    return state, most


def through(df: DataFrame, handlers: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """The stage handlers, functions of a DataFrame, one after the other."""
    for handler in handlers:
        df = df.transform(handler)
    return df


def with_registry(rows: DataFrame, operator: str, registry: Sequence[tuple], schema: str) -> DataFrame:
    """rows with the columns of their operator's entry in a registry (a fixed table of a few rows); unknown operators get nulls."""
    table = rows.sparkSession.createDataFrame(list(registry), schema)
    return rows.join(F.broadcast(table), operator, "left")
