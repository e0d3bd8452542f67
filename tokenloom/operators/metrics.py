"""Losses and run metrics.

The loss table comes from G17: a count model re-aiming the adaptive-softmax split (head slot
term + within-bin term) with add-one smoothed counts from the train split in place of learnt
weights. The per-id tables are joined by their size; everything per token or per step is a plain aggregate.
A caller's own metrics are lists of parts and finals (``Metric``), merged alike over batches and streams.
"""

from __future__ import annotations

import math

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.joins import lookup_join
from tokenloom.operators.vocab import bin_of

LN2 = math.log(2.0)


def count_model(train: DataFrame, vocab: DataFrame, cutoffs: list[int]) -> DataFrame:
    """G17 model: (id, loss) for every vocabulary id.

    slot(x) = x for head ids (x < cutoffs[1]), cutoffs[1] + b for an id in tail bin b;
    P(slot) = (count(slot) + 1) / (N + H), H = cutoffs[1] + number of tail bins;
    P(x | tail bin b) = (count(x) + 1) / (count(bin b) + width of bin b);
    loss(x) = -ln P(slot(x)) - [x in a tail bin] ln P(x | bin).
    """
    from tokenloom.session import materialize
    c1, H = cutoffs[1], cutoffs[1] + len(cutoffs) - 2
    cnt = train.groupBy("id").agg(F.count(F.lit(1)).alias("cnt"))
    m = vocab.select("id").join(cnt, "id", "left").fillna(0, ["cnt"])
    m = materialize(m.withColumn("bin", bin_of(F.col("id"), cutoffs)), "count-model")
    # a slot is a head id or a whole tail bin, so the totals of the bins (one row each) are all that a window over the model would give
    held = {r["bin"]: r["n"] for r in m.groupBy("bin").agg(F.sum("cnt").alias("n")).collect()}
    total = float(sum(held.values()) + H)
    head, tail = F.col("cnt"), F.lit(0.0)
    for b in range(1, len(cutoffs) - 1):
        here = F.col("bin") == b
        head = F.when(here, F.lit(held.get(b, 0))).otherwise(head)
        tail = F.when(here, F.ln((F.col("cnt") + 1) / F.lit(float(held.get(b, 0) + cutoffs[b + 1] - cutoffs[b])))).otherwise(tail)
    return m.select("id", (-(F.ln((head + 1) / F.lit(total)) + tail)).alias("loss"))


def token_losses(stream: DataFrame, model: DataFrame) -> DataFrame:
    """Per token loss by a join with the model table, by its size (``joins.lookup_join``)."""
    return lookup_join(stream, model, "id")


def step_log(losses: DataFrame, N: int, B: int, T: int) -> DataFrame:
    """Per evaluation step (= window w): mean loss over the labels of all rows, token count.
    A token at column c >= 1 is a label of window (c-1) div T."""
    S = N // B
    g = losses.filter(F.col("p") < F.lit(B * S)).withColumn("c", F.pmod(F.col("p"), F.lit(S)))
    g = g.filter(F.col("c") >= 1).withColumn("step", F.expr(f"(c - 1) div {T}"))
    g = g.withColumn("core_row", F.expr(f"p div {max(S, 1)}"))
    return g


def step_means(labels: DataFrame) -> DataFrame:
    """G12 per step: (step, n, loss)."""
    return labels.groupBy("step").agg(F.count(F.lit(1)).alias("n"), F.avg("loss").alias("loss"))


MERGES: dict[str, tuple[Callable, Callable]] = {
    "sum": (F.sum, F.sum), "count": (F.count, F.sum), "min": (F.min, F.min), "max": (F.max, F.max),
}


@dataclass(frozen=True)
class Metric:
    """A caller's metric: named parts, each (kind of MERGES, column of the log), and the final column as a function of the merged parts by name."""
    name: str
    parts: dict[str, tuple[str, Column]]
    final: Callable[[dict[str, Column]], Column]


class MetricSet:
    """Several metrics over a log in one aggregation. Partial rows of batches, files or stream epochs merge to the same result, as each part is a
    sum, count, minimum or maximum. Parts and finals are checked against the log's columns before anything runs."""

    def __init__(self, metrics: list[Metric], log: DataFrame):
        self.metrics = metrics
        if len({m.name for m in metrics}) != len(metrics) or not metrics:
            raise ValueError("metrics need names of their own")
        self.parts = {f"{m.name}__{p}": (kind, c) for m in metrics for p, (kind, c) in m.parts.items()}
        if len(self.parts) != sum(len(m.parts) for m in metrics):
            raise ValueError("two parts have one name")
        for key, (kind, _) in self.parts.items():
            if kind not in MERGES:
                raise ValueError(f"{key}: {kind} is none of {', '.join(MERGES)}")
        try:
            for key, (_, c) in self.parts.items():
                log.groupBy().agg(F.max(c.isNull()))  # an aggregate inside an aggregate is refused here
            self.finals(self.partial(log.limit(0)))
        except AnalysisException as e:
            raise ValueError(f"a metric doesn't fit the log: {e}") from None

    def partial(self, log: DataFrame, by: list[str] | None = None) -> DataFrame:
        """The parts of ``log`` (by the columns ``by``), one column each."""
        return log.groupBy(*(by or [])).agg(*[MERGES[kind][0](c).alias(key) for key, (kind, c) in self.parts.items()])

    def merge(self, partials: DataFrame, by: list[str] | None = None) -> DataFrame:
        return partials.groupBy(*(by or [])).agg(*[MERGES[kind][1](F.col(f"`{key}`")).alias(key) for key, (kind, _) in self.parts.items()])

    def finals(self, merged: DataFrame, by: list[str] | None = None) -> DataFrame:
        """The metrics from merged parts; one row without rows, each metric what its final makes of empty parts."""
        return merged.select(*(by or []), *[m.final({p: F.col(f"`{m.name}__{p}`") for p in m.parts}).alias(m.name) for m in self.metrics])

    def evaluate(self, log: DataFrame, by: list[str] | None = None) -> DataFrame:
        return self.finals(self.partial(log, by), by)


def step_metrics() -> list[Metric]:
    """G9's: over a log of steps (loss)."""
    loss, one = F.col("loss"), F.lit(1)
    return [Metric("perplexity", {"s": ("sum", F.exp(loss)), "n": ("count", loss)}, lambda p: F.try_divide(p["s"], p["n"])),
            Metric("bpc", {"s": ("sum", loss), "n": ("count", loss)}, lambda p: F.try_divide(p["s"], p["n"]) / F.lit(LN2)),
            Metric("steps", {"n": ("count", one)}, lambda p: p["n"])]


def token_metrics() -> list[Metric]:
    """G10's: over a log of steps (loss, n)."""
    parts = {"s": ("sum", F.col("loss") * F.col("n")), "n": ("sum", F.col("n"))}
    return [Metric("loss", parts, lambda p: F.try_divide(p["s"], p["n"])), Metric("perplexity", parts, lambda p: F.exp(F.try_divide(p["s"], p["n"]))),
            Metric("bpc", parts, lambda p: F.try_divide(p["s"], p["n"]) / F.lit(LN2))]


def ppl_step_mean(log: DataFrame) -> DataFrame:
    """perplexity = mean over steps of exp(step loss); bits = mean loss / ln 2."""
    return MetricSet(step_metrics(), log).evaluate(log)


def ppl_token_weighted(log: DataFrame) -> DataFrame:
    """Token-weighted loss sum(loss*n)/sum(n), then exp and / ln 2 (null on no rows)."""
    return MetricSet(token_metrics(), log).evaluate(log)


def replica_mean(labels: DataFrame, b: int, hosts: int, cores: int) -> DataFrame:
    """Per step, each core's mean loss summed over cores and hosts, divided by hosts*cores."""
    core = F.expr(f"core_row div {b}")
    per = labels.withColumn("core", core).groupBy("step", "core").agg(F.avg("loss").alias("l"))
    return per.groupBy("step").agg((F.sum("l") / F.lit(hosts * cores)).alias("loss"))


def capacity_losses(examples: DataFrame, model: DataFrame, head_hi: int) -> DataFrame:
    """G11 input: each label of fixed examples with ``kept`` = head id, or a tail id whose
    position holds a slot within its bin's capacity (W4 on the target side)."""
    kept_pos = F.flatten(F.transform("tgt_bins", lambda b: F.filter(b["tup"], lambda v, k: k % 2 == 0)))
    e = examples.select("w", "sample_id", kept_pos.alias("_kp"), F.posexplode("labels").alias("i", "id"))
    e = e.withColumn("kept", (F.col("id") < F.lit(head_hi)) | F.array_contains("_kp", F.col("i").cast("bigint")))
    return lookup_join(e.drop("_kp"), model, "id")


def loss_capacity_mean(tokens: DataFrame, group: list[str]) -> DataFrame:
    """Tokens over bin capacity leave both the sum and the count."""
    k = F.col("kept").cast("int")
    return tokens.groupBy(*group).agg(F.sum(k).alias("n_kept"), F.try_divide(F.sum(F.col("loss") * k), F.sum(k)).alias("loss"))


def loop_mean_loss(log: DataFrame, iterations: int, step: str = "step", loss: str = "loss") -> DataFrame:
    """Mean training loss per loop of ``iterations`` steps."""
    return log.groupBy(F.expr(f"`{step}` div {iterations}").alias("loop")).agg(
        F.avg(loss).alias("mean_loss"), F.count(F.lit(1)).alias("steps"))


def throughput(log: DataFrame, batch_size: int, every: int, step: str = "step", ts: str = "ts") -> DataFrame:
    """Per reporting span of ``every`` steps: steps/s over the span and examples/s =
    batch size * steps/s (null when the span has no elapsed time)."""
    g = log.groupBy(F.expr(f"`{step}` div {every}").alias("span")).agg(
        (F.max(step) - F.min(step)).alias("steps"),
        F.timestamp_diff("MICROSECOND", F.min(ts), F.max(ts)).alias("us"))
    sps = F.when(F.col("us") > 0, F.col("steps") / (F.col("us") / F.lit(1e6)))
    return g.select("span", sps.alias("steps_per_sec"), (sps * F.lit(batch_size)).alias("examples_per_sec"))


def lr_by_step(log: DataFrame, lr: float, warmup: int, train_steps: int, min_ratio: float, step: str = "step") -> DataFrame:
    """Linear warm-up ``step / warmup * lr``, then cosine decay to ``min_ratio * lr`` over
    ``train_steps - warmup`` steps."""
    s = F.col(step).cast("double")
    decay_steps = float(train_steps - warmup)
    t = F.least(s - F.lit(float(warmup)), F.lit(decay_steps))
    cosine = 0.5 * (1 + F.cos(F.lit(math.pi) * t / F.lit(decay_steps)))
    decayed = F.lit(lr) * ((1 - min_ratio) * cosine + F.lit(min_ratio))
    warm = s / F.lit(float(warmup)) * F.lit(lr) if warmup > 0 else F.lit(0.0)
    return log.withColumn("lr", F.when(s < F.lit(float(warmup)), warm).otherwise(decayed))


def eval_capped(log: DataFrame, num_batch: int, max_eval_batch: int, step: str = "step") -> DataFrame:
    """evaluate at most ``max_eval_batch`` steps when it is > 0."""
    n = min(num_batch, max_eval_batch) if max_eval_batch > 0 else num_batch
    return log.filter(F.col(step) < F.lit(n))


def eval_ratio(log: DataFrame, num_batch: int, ratio: int, step: str = "step") -> DataFrame:
    """The first ``num_batch div ratio`` steps of a log."""
    return log.filter(F.col(step) < F.lit(num_batch // ratio))
