"""Mixing sources to target weights by repeating documents.

All of it is DataFrame expressions: sizes are summed by source, a rate follows
for each source, and a document is taken ``floor(rate)`` times and once more if
its hash falls below the fraction. Draws depend on the document alone, so a
second run, or a task that runs again, takes the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.windows import number_rows
from .common import stage, word_count

WEIGHTS = (5, 2, 1)
TURNS = 32  # turns of the draws among which each source has the one that comes nearest its target


def draw(text: str = "text", key: str = "doc_id", seed: str = "mix") -> Column:
    """A number in [0, 1) from the key's hash, or from the text's where the key is null."""
    who = F.coalesce(F.col(key).cast("string"), F.md5(text), F.lit(""))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), who)), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = 3) -> DataFrame:
    """(source, source_size, target, rate): one row for each source of ``sizes`` (source, size).

    Sources in the order of their code points, null last, have the weights in
    turn. Each gets its weight's share of all sizes, but at most ``most`` times
    its own; what is above goes to the others by weight until none is above. Only
    sums come to the driver, one pair a round. A source of size 0 has target and
    rate 0.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ordered = number_rows(stage(per, "sources"), ["source"], "__n", single_task_rows=0)
    turn = ((F.col("__n") - 1) % len(weights)).cast("int")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1)
    weighed = stage(ordered.select("source", "source_size", weight.alias("weight")), "sources")
    cap = F.col("source_size") * most
    level = 0.0
    while True:
        above = F.col("weight") * F.lit(level) > cap
        sums = weighed.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(above, cap).otherwise(0)).alias("capped"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not sums["all"] or not sums["open"]:
            break
        after = (sums["all"] - sums["capped"]) / sums["open"]
        if after <= level:
            break
        level = after
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(level))
    return weighed.select(
        "source", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def _copies(turn: Column) -> Column:
    """Times that a document is taken: whole rate, and once more if its turned draw is below the rest."""
    whole = F.floor("rate")
    turned = F.col("draw") + turn / F.lit(float(TURNS))
    turned = turned - F.floor(turned)
    return whole + F.when(turned < F.col("rate") - whole, 1).otherwise(0)


def _planned(sizes: DataFrame, weights: Sequence[float], most: int) -> DataFrame:
    """``targets`` with the turn of each source whose sum of taken sizes is nearest to its target."""
    rated = targets(sizes, weights, most)
    joined = sizes.join(rated, sizes["source"].eqNullSafe(rated["source"])).drop(sizes["source"])
    sums = joined.groupBy("source", "source_size", "target", "rate").agg(
        *[F.sum(F.col("size") * _copies(F.lit(t))).alias(f"__{t}") for t in range(TURNS)]
    )
    tries = [F.struct(F.abs(F.col(f"__{t}") - F.col("target")).alias("off"), F.lit(t).alias("turn")) for t in range(TURNS)]
    best = F.array_min(F.array(*tries))["turn"]
    return stage(sums.select("source", "source_size", "target", "rate", best.alias("turn")), "rates")


def measured(docs: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, source, size, draw) of each row, stored: texts are read once."""
    return stage(
        docs.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), draw(text, key).alias("draw")),
        "sizes",
    )


def taken(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = 3, source: str = "source", text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, size, source_size, target, copies): how often the mix takes each row.

    Sizes are numbers of words, 0 for null and empty texts. Repeated rows have
    the same draw. Null sources are one source, the last. An empty table gives no
    rows; other columns are not looked at.
    """
    sizes = measured(docs, source, text, key)
    rates = _planned(sizes, weights, most)
    joined = sizes.join(rates, sizes["source"].eqNullSafe(rates["source"]))
    return joined.select(
        F.col("key").alias(key), "size", "source_size", "target", _copies(F.col("turn")).cast("long").alias("copies")
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = 3, source: str = "source", text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns."""
    rates = _planned(measured(docs, source, text, key), weights, most).select(
        F.col("source").alias("__source"), "rate", "turn"
    )
    own = docs.select(F.struct("*").alias("row"), draw(text, key).alias("draw"), F.col(source).alias("__of"))
    joined = own.join(rates, F.col("__of").eqNullSafe(F.col("__source")))
    times = joined.select("row", _copies(F.col("turn")).cast("int").alias("copies")).filter("copies > 0")
    return times.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
