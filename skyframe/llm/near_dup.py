"""MinHash near-duplicates with tensored banding.

Two collections of ``side`` short hashes, each made of ``width`` minhashes,
are computed per text; the table keys are all side * side pairs of one hash
of either collection.  So 2 * side * width minhashes serve side**2 tables of
2 * width minhashes each, about a square root of what plain banding computes.
A pair at likeness s shares a key with probability (1 - (1 - s**width)**side)**2.

Candidates are verified on full shingle sets.  Texts with equal sets are one
node.  In each table key the members are compared with two hubs, not with each
other; what they share with the hubs then bounds what any two of them share,
and only members of different components that the bounds allow are compared
pairwise.  So no candidate that could join two components is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .scratch import discard, in_arrow, landed
from .words import U64, distinct, long_lists, mix, pieces, shingles, words

SIDE, WIDTH = 9, 2


def _signatures(k: int, side: int, width: int):
    rng = np.random.default_rng(7)
    factors = rng.integers(1, 2**64 - 1, 2 * side * width, dtype=U64) | U64(1)
    shifts = rng.integers(1, 2**64 - 1, 2 * side * width, dtype=U64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                w = words(part.column("text"))
                values, at = shingles(w.hashes, w.offsets, k)
                sets = distinct(values, at)
                some = np.flatnonzero(np.diff(at) > 0)
                short = np.zeros((len(w), 2 * side), np.int64)
                if len(some):
                    lows = at[:-1][some]
                    for c in range(2 * side):
                        band = np.zeros(len(some), U64)
                        for j in range(c * width, (c + 1) * width):
                            band = mix(band + np.minimum.reduceat((values * factors[j] + shifts[j]) >> U64(24), lows))
                        short[some, c] = band.view(np.int64)
                d1 = np.array([mix(s).sum(dtype=U64) if len(s) else U64(0) for s in sets], U64)
                d2 = np.array([mix(s ^ U64(0x5BF03635)).sum(dtype=U64) if len(s) else U64(0) for s in sets], U64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                     long_lists(list(short[:, :side])), long_lists(list(short[:, side:]))],
                    names=["id", "n", "d1", "d2", "left", "right"])

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                w = words(part.column("text"))
                sets = distinct(*shingles(w.hashes, w.offsets, k))
                yield pa.RecordBatch.from_arrays([part.column("id"), long_lists(sets)], names=["id", "members"])

    return run


def _hub_pairs(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """(a, b): the hub of every key with each other member of the key."""
    return members.join(hubs, "key").filter("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()


def _mixed(tables: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the keys that hold several components."""
    placed = tables.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high").select("key")
    return placed.join(several, "key")


def _inside(members: DataFrame, hubs: DataFrame, tested: DataFrame, name: str) -> DataFrame:
    """``members`` with the number of shingles that each shares with the hub of its key."""
    of_hub = tested.select(F.col("a").alias("hub"), F.col("b").alias("node"), "both")
    return (members.join(hubs, "key").join(of_hub, ["hub", "node"], "left")
            .withColumn(name, F.when(F.col("hub") == F.col("node"), F.col("n")).otherwise(F.col("both"))).drop("hub", "both"))


def _across(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of one key that lie in different components and can be linked.

    Of the shingles that two sets share, those in a hub's set are at most what the lesser of the
    two has of it, and the others at most what the lesser has of shared shingles (c) outside of it.
    A pair is taken from the first table only whose key it shares."""
    side = members.join(nodes.select("node", "left", "right"), "node")
    other = side.select(*[F.col(c).alias(c if c == "key" else f"{c}_b") for c in side.columns])
    both = side.join(other, "key").filter("component < component_b")
    most = F.least("c", "c_b")
    for i in ("i1", "i2"):
        most = F.least(most, F.least(i, f"{i}_b") + F.least(F.col("c") - F.col(i), F.col("c_b") - F.col(f"{i}_b")))
    both = both.filter(100 * most >= percent * (F.col("n") + F.col("n_b") - most))
    first = [F.array_position(F.zip_with(x, f"{x}_b", lambda p, q: p == q), True) for x in ("left", "right")]
    return both.filter((first[0] == F.col("i") + 1) & (first[1] == F.col("j") + 1)).select(F.col("node").alias("a"), F.col("node_b").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    percent: int = 80, side: int = SIDE, width: int = WIDTH) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    Rows whose shingle sets have 100 * intersection >= percent * union are
    linked; ``component_id`` is the least id reachable and ``kept`` marks it.
    Texts that are null, empty or without words have an empty set and are
    linked with nothing.  A null id keeps component null and is kept, as
    nothing can refer to it.  Rows that share an id are one document: their
    links are taken together, and identical rows get identical results.
    An empty table gives an empty result; columns other than the two named
    are not read."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sig = landed(in_arrow(rows, _signatures(k, side, width), "id long, n long, d1 long, d2 long, left array<long>, right array<long>"), "signatures")
    nodes = landed(sig.filter("n > 0 AND id IS NOT NULL").groupBy("d1", "d2").agg(
        F.min("id").alias("node"), F.first("n").alias("n"), F.first("left").alias("left"), F.first("right").alias("right")), "nodes")

    keys = (nodes.select("node", "n", F.posexplode("left").alias("i", "x"), "right")
            .select("node", "n", "i", "x", F.posexplode("right").alias("j", "y"))
            .select(F.xxhash64("i", "x", "j", "y").alias("key"), "node", "n", "i", "j"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("key")
    tables = landed(keys.join(shared, "key"), "tables")

    members = tables.select(F.col("node").alias("id")).distinct()
    sets = landed(in_arrow(rows.join(members, "id", "left_semi"), _sets(k), "id long, members array<long>"), "sets")

    def compared(pairs: DataFrame) -> DataFrame:
        """(a, b, both, linked) of pairs; the wide row travels once per pair, toward its partner."""
        one = pairs.join(sets.select(F.col("id").alias("b"), F.col("members").alias("of_b")), "b")
        two = one.join(sets.select(F.col("id").alias("a"), F.col("members").alias("of_a")), "a")
        both = F.size(F.array_intersect("of_a", "of_b")).cast("long")
        linked = 100 * both >= percent * (F.size("of_a") + F.size("of_b") - both)
        return landed(two.select("a", "b", both.alias("both"), linked.alias("linked")).groupBy("a", "b").agg(F.max("both").alias("both"), F.max("linked").alias("linked")), "compared")

    # every key's least node is compared with its other members
    hubs = landed(tables.groupBy("key").agg(F.min("node").alias("hub")), "hubs")
    tested = compared(_hub_pairs(tables, hubs))
    found = components(tested.filter("linked"), "a", "b")

    # where that leaves several components, so is the member with the largest share of shared shingles
    first = landed(_mixed(tables, found), "region")
    own = (sets.join(first.select(F.col("node").alias("id")).distinct(), "id", "left_semi").select("id", F.explode("members").alias("s"))
           .groupBy("s").agg(F.count(F.lit(1)).alias("times"), F.min("id").alias("node")).filter("times = 1")
           .groupBy("node").agg(F.count(F.lit(1)).alias("own")))
    known = landed(first.drop("component").join(own, "node", "left").withColumn("c", F.col("n") - F.coalesce("own", F.lit(0))).drop("own"), "region")
    centres = landed(known.groupBy("key").agg(F.max_by("node", F.struct(F.col("c") / F.col("n"), -F.col("node"))).alias("hub")), "hubs")
    again = compared(_hub_pairs(known, centres).join(tested, ["a", "b"], "left_anti"))
    tested = tested.unionByName(again)
    back = tested.select(F.col("b").alias("a"), F.col("a").alias("b"), "both", "linked")
    tested = landed(tested.unionByName(back).groupBy("a", "b").agg(F.max("both").alias("both"), F.max("linked").alias("linked")), "tested")
    found = components(again.filter("linked").select("a", "b").union(found), "a", "b")

    # members of different components that both bounds allow are compared pairwise
    apart = _inside(_inside(_mixed(known, found), hubs, tested, "i1"), centres, tested, "i2")
    last = compared(_across(apart, nodes, percent).distinct().join(tested, ["a", "b"], "left_anti"))
    found = components(last.filter("linked").select("a", "b").union(found), "a", "b")
    discard(tables, hubs, first, known, centres, sets)

    names = nodes.select("d1", "d2", "node").join(found, "node", "left").select("d1", "d2", F.coalesce("component", "node").alias("component"))
    out = sig.select("id", "n", "d1", "d2").join(names, ["d1", "d2"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), component).alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
