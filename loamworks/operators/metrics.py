"""Evaluation metrics, regressions and reports from tables of losses, predictions and runs."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import bound


def centered(accuracy: Column, baseline: Column) -> Column:
    """Accuracy above a baseline in percent, 1 at best."""
    return (accuracy - 0.01 * baseline) / (1.0 - 0.01 * baseline)


def bits_per_byte(nats: str, n_bytes: str) -> Column:
    """Bits a byte over targets of at least one byte; infinite without bytes."""
    loss = F.sum(F.when(F.col(n_bytes) > 0, F.col(nats)).otherwise(0.0))
    total = F.coalesce(F.sum(n_bytes), F.lit(0))
    return F.when(total == 0, F.lit(float("inf"))).otherwise(loss / (F.lit(math.log(2)) * F.when(total > 0, total)))


def lowest_mean_loss(losses: DataFrame, by: Sequence[str], option: str, loss: str) -> DataFrame:
    """``by, choice``: the option of the least mean loss, the first among equals."""
    means = losses.groupBy(*by, option).agg(F.avg(loss).alias("_m"))
    return means.groupBy(*by).agg(F.min_by(option, F.struct("_m", option)).alias("choice"))


def pass_at_k(samples: DataFrame, k: int, by: str, number: str, correct: str) -> DataFrame:
    """``k, pass_at_k``: problems with a correct answer among the first k samples."""
    first = samples.groupBy(by).agg(F.min(F.when(F.col(correct), F.col(number))).alias("first"))
    cuts = first.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(k))))
    return cuts.groupBy("k").agg(F.avg(F.when(F.col("first") < F.col("k"), 1.0).otherwise(0.0)).alias("pass_at_k"))


def advantages(rollouts: DataFrame, by: str, reward: str) -> DataFrame:
    """Rewards less their group's mean, not scaled."""
    mean = rollouts.groupBy(by).agg(F.avg(reward).alias("_mean"))
    return rollouts.join(mean, by).withColumn("advantage", F.col(reward) - F.col("_mean")).drop("_mean")


def common_length(sequences: DataFrame, by: str, ids: str, suffix: bool = False) -> DataFrame:
    """``by, n``: how many ids all sequences of a group share at their start (or end)."""
    rows = sequences.select(by, (F.reverse(ids) if suffix else F.col(ids)).alias("x"))
    least = rows.groupBy(by).agg(F.min(F.size("x")).alias("least"))
    at = rows.select(by, F.posexplode("x").alias("pos", "id")).groupBy(by, "pos").agg(F.min("id").alias("a"), F.max("id").alias("z"))
    differ = at.filter("a <> z").groupBy(by).agg(F.min("pos").alias("first"))
    return least.join(differ, by, "left").select(by, F.least("least", F.coalesce("first", "least")).alias("n"))


def prompt_spans(prompts: DataFrame, kind: str, item: str = "item", option: str = "option", ids: str = "ids") -> DataFrame:
    """``item, option, ids, span_start, span_end``: the ids of each prompt whose losses count, end exclusive.

    ``multiple_choice``: after the start that an item's prompts share.
    ``schema``: the end that they share.  ``language_modeling``: what the
    prompt of option 1 adds to that of option 0, of which it must be a longer
    form; the prompts of option 1 are returned.
    """
    if kind == "language_modeling":
        short, long = (F.max(F.when(F.col(option) == k, F.col(ids))) for k in (0, 1))
        both = prompts.groupBy(item).agg(short.alias("_short"), long.alias("_long"))
        start, end = F.size("_short"), F.size("_long")
        longer = (start < end) & (F.slice("_long", F.lit(1), start) == F.col("_short"))
        checked = F.when(longer, start).otherwise(F.raise_error(F.lit("a prompt must go on from the one without its continuation")).cast("int"))
        return both.select(item, F.lit(1).alias(option), F.col("_long").alias(ids), checked.alias("span_start"), end.alias("span_end"))
    if kind not in ("multiple_choice", "schema"):
        raise ValueError(f"unknown kind of item: {kind}")
    shared = common_length(prompts, item, ids, suffix=kind == "schema")
    end = F.size(ids)
    start = F.col("n") if kind == "multiple_choice" else end - F.col("n")
    return prompts.join(shared, item).select(item, option, ids, start.alias("span_start"), end.alias("span_end"))


def sampled_token(logits: Column, draw: Column, temperature: float = 1.0, top_k: int | None = None) -> Column:
    """The index chosen by a ``draw`` from 0 to 1 among the softmax of the ``top_k`` largest logits.

    Logits go from the largest to the least, equal ones by index; at
    temperature 0 it is the first largest.
    """
    if temperature < 0:
        raise ValueError("a temperature isn't negative")
    if temperature == 0:
        return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")
    ranked = F.sort_array(F.transform(logits, lambda x, i: F.struct(x.cast("double").alias("v"), (-i).alias("at"))), asc=False)
    ranked = F.slice(ranked, 1, top_k) if top_k else ranked

    def weigh(kept: Column) -> Column:
        return F.transform(kept, lambda p: F.struct(F.exp((p["v"] - kept[0]["v"]) / temperature).alias("w"), (-p["at"]).alias("id")))

    def choose(weights: Column) -> Column:
        total = F.aggregate(weights, F.lit(0.0), lambda a, p: a + p["w"])
        return bound(total * draw, lambda goal: walk(weights, goal))

    def walk(weights: Column, goal: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("int").alias("id"))
        step = lambda a, p: F.struct((a["sum"] + p["w"]).alias("sum"), F.when(a["id"].isNull() & (a["sum"] + p["w"] >= goal), p["id"]).otherwise(a["id"]).alias("id"))
        return F.coalesce(F.aggregate(weights, start, step)["id"], F.element_at(weights, -1)["id"])

    return bound(ranked, lambda kept: bound(weigh(kept), choose))


def ema(values: Column, beta: float = 0.9) -> Column:
    """Bias-corrected exponential mean of an array in order."""
    start = F.struct(F.lit(0.0).alias("m"), F.lit(1.0).alias("c"))
    out = F.aggregate(values, start, lambda a, x: F.struct((beta * a["m"] + (1 - beta) * x).alias("m"), (a["c"] * beta).alias("c")))
    return F.try_divide(out["m"], 1 - out["c"])


def quadratic_minimum(points: DataFrame, by: str, x: str, y: str) -> DataFrame:
    """``by, a, b, c, x_min, n``: least squares of y on 1, x, x² from power sums; the vertex.

    Where the parabola isn't open upwards, ``x_min`` is the x of the least y.
    Values of x are moved to their group's mean first, which keeps sums small.
    """
    mean = points.groupBy(by).agg(F.avg(x).alias("_mx"))
    p = points.join(mean, by).withColumn("_u", F.col(x) - F.col("_mx"))
    u, v = F.col("_u"), F.col(y)
    s = p.groupBy(by).agg(
        F.count("*").cast("double").alias("n"), F.first("_mx").alias("mx"), *(F.sum(F.pow(u, F.lit(float(k)))).alias(f"s{k}") for k in range(1, 5)),
        F.sum(v).alias("t0"), F.sum(v * u).alias("t1"), F.sum(v * u * u).alias("t2"), F.min_by(x, y).alias("raw"),
    )
    c = F.col
    det = c("n") * (c("s2") * c("s4") - c("s3") * c("s3")) - c("s1") * (c("s1") * c("s4") - c("s3") * c("s2")) + c("s2") * (c("s1") * c("s3") - c("s2") * c("s2"))
    da = c("n") * (c("s2") * c("t2") - c("s3") * c("t1")) - c("s1") * (c("s1") * c("t2") - c("s3") * c("t0")) + c("s2") * (c("s1") * c("t1") - c("s2") * c("t0"))
    db = c("n") * (c("t1") * c("s4") - c("s3") * c("t2")) - c("t0") * (c("s1") * c("s4") - c("s3") * c("s2")) + c("s2") * (c("s1") * c("t2") - c("t1") * c("s2"))
    fit = s.select(by, "n", "raw", "mx", F.try_divide(da, det).alias("a"), F.try_divide(db, det).alias("b"))
    vertex = c("mx") - F.try_divide(c("b"), 2 * c("a"))
    return fit.select(by, c("n").cast("long").alias("n"), "a", F.when(c("a") > 0, vertex).otherwise(c("raw")).alias("x_min"))


def interpolated(points: DataFrame, wanted: DataFrame, by: str, x: str, y: str, at: str) -> DataFrame:
    """``by, value``: y at ``at`` on straight lines between points; the end values beyond them."""
    w = Window.partitionBy(by).orderBy(x)
    pieces = points.select(by, F.col(x).alias("x0"), F.col(y).alias("y0"), F.lead(x).over(w).alias("x1"), F.lead(y).over(w).alias("y1"))
    near = pieces.join(wanted.select(by, F.col(at).alias("_t")), by)
    inside = near.filter("_t >= x0 and _t < x1").select(by, (F.col("y0") + (F.col("y1") - F.col("y0")) * (F.col("_t") - F.col("x0")) / (F.col("x1") - F.col("x0"))).alias("value"))
    ends = near.groupBy(by).agg(F.min("x0").alias("lo"), F.max("x0").alias("hi"), F.min_by("y0", "x0").alias("ylo"), F.max_by("y0", "x0").alias("yhi"), F.first("_t").alias("_t"))
    outside = ends.filter("_t < lo or _t >= hi").select(by, F.when(F.col("_t") < F.col("lo"), F.col("ylo")).otherwise(F.col("yhi")).alias("value"))
    return inside.unionByName(outside)


def ridge(points: DataFrame, xs: Sequence[str], y: str, alpha: float) -> list[float]:
    """Intercept (without penalty) and coefficients, from one pass of cross sums.

    The sums are a few numbers, whatever the number of rows.
    """
    import numpy as np

    columns = [F.lit(1.0), *(F.col(x).cast("double") for x in xs)]
    target = F.col(y).cast("double")
    k = len(columns)
    row = points.agg(*(F.sum(a * b) for a in columns for b in columns), *(F.sum(a * target) for a in columns)).first()
    gram, right = np.array(row[: k * k], dtype=float).reshape(k, k), np.array(row[k * k :], dtype=float)
    penalty = np.eye(k) * alpha
    penalty[0, 0] = 0
    return np.linalg.solve(gram + penalty, right).tolist()


def error_streaks(events: DataFrame, order: str, outcome: str, by: str) -> DataFrame:
    """Add ``streak``: filter errors since the last accept, within ``by``."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    islands = events.withColumn("_island", F.sum(F.when(F.col(outcome) == "accepted", 1).otherwise(0)).over(w))
    inside = Window.partitionBy(by, "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return islands.withColumn("streak", F.sum(F.when(F.col(outcome) == "filter_error", 1).otherwise(0)).over(inside)).drop("_island")


def report(rows: DataFrame, stages: Sequence[str]) -> DataFrame:
    """``metric`` by stage, ``-`` where missing; CORE first, ChatCORE last, others by name."""
    wide = rows.groupBy("metric").pivot("stage", list(stages)).agg(F.first("value"))
    place = F.when(F.col("metric") == "CORE", 0).when(F.col("metric") == "ChatCORE", 2).otherwise(1)
    return wide.select("metric", *(F.coalesce(F.col(s), F.lit("-")).alias(s) for s in stages), place.alias("place"))


def shown(value: Column) -> Column:
    """A number for a report: four places for fractions, thousands marked from 10,000 on."""
    whole = value == F.floor(value)
    return F.when(whole & (F.abs(value) >= 10_000), F.format_number(value, 0)).when(whole, value.cast("long").cast("string")).otherwise(F.format_string("%.4f", value))
