"""Embedding near-duplicates by sorted projection passes.

Each pass hashes a vector to the signs of random projections, one bit each, and orders
all vectors lexicographically by these bits. Close vectors share long prefixes, so each
is compared, in double precision, with the bounded window of its neighbours in that
order. Verified pairs of all passes are united into components.

The number of passes grows with the number of vectors, so that a pair at the threshold
is missed by all of them with a chance of about ``aim``. Where vectors are dense, all share
long prefixes and a window reaches less far. That shows in the prefix that a vector shares
with the ends of its window: a neighbour that shares more bits is inside. If the chances
of all passes leave more than ``miss`` for a pair at the threshold, the vector is crowded.
A pair whose members are both crowded may be lost, so crowded vectors are all compared
with each other, in tiles; for any other pair the estimate of one member is small enough.

A window is too small for a group with more members than it holds, but the passes still
connect the group. So links are counted afterwards and exactly: inside each component
every pair is compared, large components in tiles of bounded size spread over tasks;
only sums per vector leave a tile. No link inside a component is lost or counted twice.

Equal vectors are one member with a weight from the start.

Defined results: vectors that are null, zero, hold null or non-finite components, or
differ in length from the most common length (the larger of equally common ones) have
no link and form their own component. Rows with a repeated id stay apart; a null id does
not name a component unless it has no other (then the name is null). Other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import store
from .components import connected_components


@dataclass(frozen=True)
class Passes:
    cosine: float = 0.95
    passes: int = 12  # at least
    window: int = 128
    bits: int = 62
    tile: int = 1024
    aim: float = 1e-4
    miss: float = 1e-3

    @property
    def agree(self) -> float:
        """The chance that a bit is the same for two vectors at the threshold."""
        return 1 - math.acos(self.cosine) / math.pi

    def passes_for(self, n: int) -> int:
        """Passes over ``n`` evenly spread vectors."""
        depth = math.log2(max(1.0, n / (2 * self.window))) + 1
        return max(self.passes, math.ceil(math.log(self.aim) / math.log1p(-(self.agree**depth))))


def _projections(dims: int, passes: int, setup: Passes) -> np.ndarray:
    return np.random.default_rng(3).standard_normal((passes, dims, setup.bits))


def _units(data, dims: int, kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(data), kind).reshape(-1, dims).astype(np.float64)
    largest = np.abs(x).max(1, keepdims=True)
    x = x / np.where(largest > 0, largest, 1)  # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Rows of equal keys, from batches sorted by them."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        values = batch[keys].to_numpy()
        cuts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(1)) + 1), len(batch)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = batch.iloc[a:b]
            if held and (held[-1][keys].iloc[-1].to_numpy() != values[a]).any():
                yield pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held)


def _local_links(linked: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each row of a symmetric matrix of links."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(linked)).min(1)
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links_of(linked: np.ndarray, node: np.ndarray) -> pd.DataFrame:
    """Links (a, b) that connect what a symmetric matrix connects."""
    some = np.flatnonzero(linked.any(1))
    label = _local_links(linked[np.ix_(some, some)])
    moved = label != np.arange(len(label))
    return pd.DataFrame({"a": node[some][label[moved]], "b": node[some][moved]})


def near_duplicates(
    vectors: DataFrame,
    setup: Passes = Passes(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """vec_id, n_links, component_id of every row."""
    kind = "<f4" if vectors.schema[vector_column].dataType.elementType.typeName() == "float" else "<f8"
    vector = F.col(vector_column)
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("v"))
    lengths = rows.where("v is not null").groupBy(F.size("v").alias("n")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("n")).head()
    dims = most.n if most else 0

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for v in batch["v"]:
                x = None if v is None or len(v) != dims else np.array(v, np.float64)
                good = x is not None and dims and np.isfinite(x).all() and x.any()
                out.append(x.astype(kind).tobytes() if good else None)
            yield pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "data": out})

    encoded = store(rows.mapInPandas(encode, "vec_id long, data binary"), "vectors")
    passes = setup.passes_for(encoded.count())
    classes = (
        encoded.where("data is not null")
        .groupBy("data")
        .agg(F.count("*").alias("weight"), F.min("vec_id").alias("first"))
    )

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node = TaskContext.get().partitionId() << 33
        powers = 1 << np.arange(setup.bits - 1, -1, -1, dtype=np.int64)
        planes = _projections(dims, passes, setup)
        for batch in batches:
            unit = _units(batch["data"], dims, kind)
            keys = np.stack([(unit @ p > 0) @ powers for p in planes], 1)
            yield batch.assign(node=np.arange(node, node + len(batch)), keys=list(keys))
            node += len(batch)

    nodes = store(
        classes.mapInPandas(
            hashed, "data binary, weight long, first long, node long, keys array<long>"
        ),
        "classes",
    )

    def ranked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            batch["shard"] = shard
            batch["row"] = np.arange(row, row + len(batch))
            row += len(batch)
            yield batch[["pass", "node", "key", "shard", "row"]]

    order = ["pass", "key", "node"]
    placed = store(
        nodes.select("node", F.posexplode("keys").alias("pass", "key"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInPandas(ranked, "pass int, node long, key long, shard int, row long"),
        "placed",
    )
    # The place in a pass: rows of the pass before the shard, and in it.
    earlier = Window.partitionBy("pass").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        placed.groupBy("pass", "shard")
        .agg(F.count("*").alias("n"), F.min("row").alias("low"))
        .select("pass", "shard", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("low")).alias("base"))
    )
    place = F.col("row") + F.col("base")
    ordered = store(
        placed.join(bases, ["pass", "shard"]).select("pass", "node", "key", place.alias("place")), "ordered"
    )
    members = (
        ordered.select("pass", "node", "place", F.floor(F.col("place") / setup.window).alias("home"))
        .join(nodes.select("node", "data"), "node")
        # Each block meets the next one, so a member is needed at home and one before.
        .select("pass", "node", "place", "home", "data", F.explode(F.array("home", F.col("home") - 1)).alias("block"))
        .where("block >= 0")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _runs(batches, ["pass", "block"]):
            unit = _units(run["data"], dims, kind)
            place, home = run["place"].to_numpy(), (run["home"] == run["block"]).to_numpy()
            linked = unit @ unit.T >= setup.cosine
            linked &= np.abs(place[:, None] - place[None, :]) <= setup.window
            linked &= home[:, None] | home[None, :]
            np.fill_diagonal(linked, False)
            if linked.any():
                yield _links_of(linked, run["node"].to_numpy())

    links = (
        members.repartition("pass", "block")
        .sortWithinPartitions("pass", "block")
        .mapInPandas(compare, "a long, b long")
    )
    links = store(links, "near").union(_crowded_links(ordered, nodes, dims, kind, setup))
    parts = connected_components(links)
    joined = store(parts.join(nodes.drop("keys"), "node"), "members")
    sizes = joined.groupBy("component").agg(F.count("*").alias("size"), F.min("first").alias("name"))
    named = joined.join(sizes, "component")
    tiles = F.ceil(F.col("size") / setup.tile).cast("int")
    mine = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    tiled = (
        named.withColumn("tiles", tiles)
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "component", "node", "weight", "data", "mine",
            F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
        )
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _runs(batches, ["component", "low", "high"]):
            unit, weight = _units(run["data"], dims, kind), run["weight"].to_numpy()
            linked = unit @ unit.T >= setup.cosine
            mine = run["mine"].to_numpy()
            if run["low"].iloc[0] != run["high"].iloc[0]:
                linked &= mine[:, None] != mine[None, :]
            np.fill_diagonal(linked, False)
            yield pd.DataFrame({"node": run["node"].to_numpy(), "linked": linked @ weight})

    tile_key = ["component", "low", "high"]
    counts = (
        tiled.repartition(*tile_key)
        .sortWithinPartitions(*tile_key)
        .mapInPandas(count, "node long, linked long")
        .groupBy("node")
        .agg(F.sum("linked").alias("linked"))
    )
    linked = named.select("node", "name").join(counts, "node")
    found = store(
        nodes.join(linked, "node", "left").select(
            "data",
            (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("name", "first").alias("component_id"),
        ),
        "found",
    )
    alone = encoded.where("data is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return encoded.join(found, "data").select("vec_id", "n_links", "component_id").union(alone)


def _crowded_links(ordered: DataFrame, nodes: DataFrame, dims: int, kind: str, setup: Passes) -> DataFrame:
    """Links (a, b) between all vectors that the passes alone would leave uncertain."""
    ends = ordered.select("pass", (F.col("place") - setup.window).alias("place"), F.col("node").alias("end"), F.col("key").alias("end_key"))
    differ = F.col("key").bitwiseXOR(F.col("end_key"))
    shared = F.when(differ == 0, setup.bits).otherwise(setup.bits - F.length(F.bin(differ)))
    met = F.pow(F.lit(setup.agree), F.col("shared") + 1)
    crowded = store(
        ordered.join(ends, ["pass", "place"])
        .select("pass", shared.alias("shared"), F.explode(F.array("node", "end")).alias("node"))
        .groupBy("node", "pass")
        .agg(F.max("shared").alias("shared"))
        .groupBy("node")
        .agg(F.sum(F.log1p(-met)).alias("chance"))
        .where(F.col("chance") > math.log(setup.miss))
        .join(nodes.select("node", "data"), "node")
        .select("node", "data"),
        "crowded",
    )
    tiles = max(1, math.ceil(crowded.count() / setup.tile))
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    tiled = (
        crowded.withColumn("mine", F.pmod(F.xxhash64("node"), F.lit(tiles)).cast("int"))
        .withColumn("other", other)
        .select("node", "data", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"))
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _runs(batches, ["low", "high"]):
            unit = _units(run["data"], dims, kind)
            linked = unit @ unit.T >= setup.cosine
            np.fill_diagonal(linked, False)
            if linked.any():
                yield _links_of(linked, run["node"].to_numpy())

    return (
        tiled.repartition("low", "high").sortWithinPartitions("low", "high").mapInPandas(compare, "a long, b long")
    )
