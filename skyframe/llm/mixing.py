"""Mixing documents to target weights by iterative proportional fitting.

Tokens are summed per cell, a combination of one level of every margin
(source, language, topic).  Raking scales the cells' weights to one margin's
targets after the other until all margins agree.  A document's probability
follows its cell's ratio of raked to present weight, scaled so that the
expected tokens are the wanted part of all, with 1 as the most; documents are
then kept by a hash of id and text.  Only the table of cells is iterated on,
as a DataFrame.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .scratch import free_name, in_arrow, landed
from .words import U64, pieces, words

TOPICS = 4
SWEEPS = 5


def with_profile(docs: DataFrame, text_col: str, tokens: str, topic: str, topics: int = TOPICS) -> DataFrame:
    """``docs`` with the number of words of every whole text, and its topic: the class with most of its words
    if words fall into ``topics`` classes by their hash (the lowest of equals).  Texts without words have topic null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text_col):
                w = words(part.column(text_col))
                counts = np.diff(w.offsets)
                text = np.repeat(np.arange(len(w)), counts)
                votes = np.bincount(text * topics + ((w.hashes >> U64(40)) % U64(topics)).astype(np.int64), minlength=len(w) * topics).reshape(-1, topics)
                found = pa.array(votes.argmax(1).astype(np.int32), mask=counts == 0)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(counts.astype(np.int64)), found], names=[*part.schema.names, tokens, topic])

    shape = StructType([*docs.schema.fields, StructField(tokens, LongType()), StructField(topic, IntegerType())])
    return in_arrow(docs, run, shape)


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """(margin, target): every level's share of the tokens to the given power, scaled to 1; below 1 it lifts small levels."""
    levels = cells.groupBy(margin).agg(F.sum("tokens").alias("s")).filter("s > 0").withColumn("p", F.pow("s", F.lit(power)))
    total = levels.agg(F.sum("p").alias("total")).first()["total"] or 1.0
    return levels.select(margin, (F.col("p") / F.lit(float(total))).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = 1e-6) -> tuple[DataFrame, dict[str, float]]:
    """``cells`` (a column per margin, ``tokens``) with ``weight``, raked to ``targets`` ({margin: (margin, target)}),
    and of each margin the largest difference from its target that is left.

    Levels that a target does not name, or that have no tokens, weigh nothing; targets are scaled to 1 over the
    levels there are.  Raking goes on until every margin meets its target within ``tolerance``, or a round of sweeps
    moves no weight by more than that: then the targets contradict each other, or nearly do (levels that would have to
    share weight have no cell in common), and the gaps say by how much they are missed."""
    for m, t in targets.items():
        cells = cells.join(t.select(F.col(m).alias("_level"), F.col("target").cast("double").alias(f"_t_{m}")), F.col(m).eqNullSafe(F.col("_level")), "left").drop("_level")
    whole = cells.agg(F.sum("tokens").alias("s")).first()["s"] or 1
    weight = F.when(F.least(*[F.coalesce(f"_t_{m}", F.lit(0.0)) for m in targets], F.col("tokens").cast("double")) > 0, F.col("tokens") / F.lit(float(whole))).otherwise(F.lit(0.0))
    cells = landed(cells.withColumn("weight", weight), "cells")
    marginal = {m: F.sum("weight").over(Window.partitionBy(m)) for m in targets}
    # a target's share among the levels that are there
    present = {m: cells.filter("weight > 0").groupBy(m).agg(F.max(f"_t_{m}").alias("t")).agg(F.sum("t").alias("t")).first()["t"] or 1.0 for m in targets}
    gaps = dict.fromkeys(targets, 0.0)
    while True:
        now = cells.withColumn("_was", F.col("weight"))
        for _ in range(SWEEPS):
            for m in targets:
                now = now.withColumn("_m", marginal[m]).withColumn("weight", F.when(F.col("_m") > 0, F.col("weight") * F.col(f"_t_{m}") / present[m] / F.col("_m")).otherwise(F.lit(0.0)))
        cells = landed(now.drop("_m"), "cells")
        # a level that had weight and lost it all is off by its whole target
        off = [F.max(F.when(F.col("_was") > 0, F.col(f"_o_{m}"))).alias(m) for m in targets]
        state = cells.withColumns({f"_o_{m}": F.abs(marginal[m] - F.col(f"_t_{m}") / present[m]) for m in targets}).agg(*off, F.max(F.abs(F.col("weight") - F.col("_was"))).alias("_moved")).first()
        cells, gaps = cells.drop("_was"), {m: state[m] or 0.0 for m in targets}
        if max(gaps.values()) <= tolerance or (state["_moved"] or 0.0) <= tolerance:
            break
    return cells.drop(*[f"_t_{m}" for m in targets]), gaps


def calibrated(cells: DataFrame, keep: float) -> DataFrame:
    """``cells`` with ``probability``: min(1, c * weight / tokens), with the c at which the expected tokens are
    ``keep`` of all (as near as the cells with weight allow)."""
    rate = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(0.0))
    cells = landed(cells.withColumn("_rate", rate), "cells")
    total = float(cells.agg(F.sum("tokens").alias("s")).first()["s"] or 0)
    c = 0.0
    while True:  # each turn makes cells certain that were not; their number is finite
        sure = F.col("_rate") * c >= 1
        s = cells.agg(F.sum(F.when(sure, F.col("tokens"))).alias("full"), F.sum(F.when(~sure, F.col("weight"))).alias("open")).first()
        free = keep * total - (s["full"] or 0)
        new = free / s["open"] if s["open"] else c
        if new <= c * (1 + 1e-12):
            break
        c = new
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("_rate") * c)).drop("_rate")


def draw(*of) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11) / F.lit(float(1 << 53))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = 0.8, power: float = 0.7, seed: int = 17,
        id_col: str = "doc_id", text_col: str = "text", margins: tuple[str, ...] = ("source", "lang"), slack: float = 0.01) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with four more columns, and what they are called ({"tokens", "topic", "probability", "kept"}: name).

    Rakes token weights to the margins and the topic.  ``targets`` gives a (level, target) table
    for any of them (the topic's is keyed "topic"); the others get their present shares to ``power``.  If a given
    target cannot be met within ``slack``, ValueError names the margins that are off; those by ``power`` are wishes:
    they come as near as the cells allow, and are left out where they keep a given target from being met.  A null level is a level.  Texts without words weigh nothing and are kept with probability ``keep``.  Equal rows share one
    fate; an empty table gives an empty result."""
    names = {n: free_name(docs, n) for n in ("tokens", "topic", "probability", "kept")}
    rows = with_profile(docs, text_col, names["tokens"], names["topic"])
    dims = {**{m: m for m in margins}, "topic": names["topic"]}
    cells = landed(rows.filter(F.col(names["tokens"]) > 0).groupBy(*[F.col(c).alias(f"m_{d}") for d, c in dims.items()]).agg(F.sum(names["tokens"]).alias("tokens")), "cells")
    wanted = {f"m_{d}": (targets[d].toDF(f"m_{d}", "target") if targets and d in targets else tempered(cells, f"m_{d}", power)) for d in dims}
    raked, gaps = rake(cells, wanted)
    given = {f"m_{d}" for d in dims if targets and d in targets}
    if any(gaps[m] > slack for m in given):  # the wishes yield
        raked, gaps = rake(cells, {m: t for m, t in wanted.items() if m in given})
    unmet = {m.removeprefix("m_"): round(gaps[m], 6) for m in given if gaps[m] > slack}
    if unmet:
        raise ValueError(f"targets cannot all be met by the documents there are; margins off by: {unmet}")
    chances = landed(calibrated(raked, keep).select(*wanted, F.col("probability").alias(names["probability"])), "chances")
    same = [F.col(c).eqNullSafe(F.col(f"m_{d}")) for d, c in dims.items()]
    on = same[0]
    for s in same[1:]:
        on = on & s
    out = rows.join(chances, on, "left").drop(*wanted).withColumn(names["probability"], F.coalesce(names["probability"], F.when(F.col(names["tokens"]) > 0, F.lit(0.0)).otherwise(F.lit(keep))))
    return out.withColumn(names["kept"], draw(F.lit(seed), F.col(id_col), F.col(text_col)) < F.col(names["probability"])), names
