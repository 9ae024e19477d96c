"""Embedding near-dedup by NN-descent.

1. Vectors are scaled to length one; equal ones are one class.
2. A first graph: blocks of vectors with equal signs on random hyperplanes keep their nearest. There are so many tables
   that a pair at the threshold meets in none with probability ``MISSED``; a bucket beyond a block is compared block by block.
3. NN-descent: the lists of neighbours, both ways, meet at their common neighbour; what is nearer
   than a list's farthest enters it. A list full of links is saturated and is enlarged. Rounds end when few links are new.
4. Links found are confirmed in double precision; their components are the candidate groups.
5. Within a component, blocks of at most ``2 * BLOCK`` vectors count all links. This is the exact way for what lists
   cannot hold, and moves a group's rows, never its pairs.
6. A fixed number of vectors, and as many that stand for one component each, are compared with all others. If a smaller share
   of an audited vector's links than wanted was known, in the mean of either sample, the graph is refined with new
   hyperplanes; if that does not do, all vectors are compared in blocks. What the audit found is added.

Vectors are compared with those of their own length: the length is part of every bucket and block, so any mixture takes one pass.

Defined results: vectors that are null, zero, or with null or non-finite components are linked with nothing and stay; a null
vec_id is linked with nothing and stays; rows repeated under one id are one vector if they agree (each row lists its links,
itself not counted) and are linked through the id if not; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import binary_parts, runs, shuffle_partitions, stored
from meterlake.llm.components import components

LIST, MOST_LIST = 8, 32
TABLE_BLOCK, MISSED = 128, 0.001
#: Rounds of descent before each audit, at least and at most; they end when this share of the links in lists is new.
ROUNDS, MOST_ROUNDS, FEW = 2, 8, 0.001
MORE_ROUNDS = 1
BLOCK, WHOLE_BLOCK = 512, 1024
AUDIT_ROWS, WANTED_RECALL = 256, 0.999
#: Half precision loses less than this in a cosine.
SLACK = 0.005


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, the vector scaled to length one as doubles, and the same in half precision; null where it has no direction."""
    for batch in batches:
        exact, half = [], []
        for v in batch.column(1).to_pylist():
            x = None
            if v and None not in v:
                a = np.array(v, float)
                top = np.abs(a).max()
                if np.isfinite(top) and top > 0:
                    a = a / top
                    x = a / np.linalg.norm(a)
            exact.append(None if x is None else (x + 0.0).tobytes())
            half.append(None if x is None else x.astype(np.float16).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(exact, pa.binary()), pa.array(half, pa.binary())], names=["vec_id", "vector", "half"])


def _matrix(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    data, _ = binary_parts(column)
    return data.view(kind).reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, those with vectors of one length at a time."""
    if batch.num_rows:
        sizes = np.diff(binary_parts(batch.column(column))[1])
        for size in np.unique(sizes).tolist():
            yield batch.filter(pa.array(sizes == size))


def _edges(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    if rows:
        a, b, s = (np.concatenate(c) for c in zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float32())], names=["a", "b", "sim"])


def _codes(seed: int, tables: int, bits: int):
    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector once per table, with its length and its signs on the table's hyperplanes."""
        for batch in (part for whole in batches for part in _by_length(whole, 1)):
            x = _matrix(batch.column(1), np.float16).astype(np.float32)
            planes = np.random.default_rng(seed).normal(size=(x.shape[1], tables * bits)).astype(np.float32)
            signs = (x @ planes > 0).reshape(len(x), tables, bits)
            code = (signs * (1 << np.arange(bits, dtype=np.int64))).sum(2) + (x.shape[1] << bits)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(0).to_numpy(), tables)),
                    pa.array(np.tile(np.arange(tables, dtype=np.int32), len(x))),
                    pa.array(code.reshape(-1)),
                ],
                names=["node", "table", "code"],
            )

    return codes


def _forest(sim: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect whatever the links of a block connect.

    Spanning trees of what is a link whatever half precision lost; of what may be one, all pairs between different trees.
    """
    sure = sim >= threshold + SLACK
    tree, open_ = np.arange(len(sim)), sure.any(1)
    a, b = [], []
    for start in np.flatnonzero(open_).tolist():
        if not open_[start]:
            continue
        open_[start], stack = False, [start]
        while stack:
            node = stack.pop()
            tree[node] = start
            new = np.flatnonzero(sure[node] & open_)
            open_[new] = False
            a.append(np.full(len(new), node))
            b.append(new)
            stack.extend(new.tolist())
    unsure = np.nonzero((sim >= threshold - SLACK) & ~sure)
    between = (unsure[0] < unsure[1]) & (tree[unsure[0]] != tree[unsure[1]])
    return np.concatenate([*a, unsure[0][between]]), np.concatenate([*b, unsure[1][between]])


def _nearest(keys: list[str], most: int, threshold: float):
    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of the rows that meet under a key, each one's nearest, and a forest of their links.

        Where two parts of a bucket meet, only the forest of the links between them.
        """
        out, size = [], 0
        for group in runs(batches, keys):
            nodes = group.column("node").to_numpy()
            if len(nodes) < 2:
                continue
            x = _matrix(group.column("half"), np.float16).astype(np.float32)
            sim = x @ x.T
            np.fill_diagonal(sim, -2)
            if "i" in keys and group.column("i")[0].as_py() != group.column("j")[0].as_py():
                part = group.column("part").to_numpy()
                sim[part[:, None] == part[None, :]] = -2
                x, y = _forest(sim, threshold)
                out.append((nodes[x], nodes[y], sim[x, y]))
                size += len(x)
                if size > 100_000:
                    yield from _edges(out)
                    out, size = [], 0
                continue
            floor = group.column("least").to_numpy() if "least" in group.column_names else np.full(len(nodes), -2.0)
            k = min(most, len(nodes) - 1)
            near = np.argpartition(-sim, k - 1, 1)[:, :k]
            value = np.take_along_axis(sim, near, 1)
            keep = value > floor[:, None]
            at = np.nonzero(keep)
            out.append((nodes[at[0]], nodes[near[at]], value[at]))
            x, y = _forest(sim, threshold)
            out.append((nodes[x], nodes[y], sim[x, y]))
            size += len(at[0]) + len(x)
            if size > 100_000:
                yield from _edges(out)
                out, size = [], 0
        yield from _edges(out)

    return nearest


def _count(threshold: float):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of each vector within a block, in ids, and one link per vector for the components."""
        for group in runs(batches, ["component", "i", "j", "length"]):
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            part = group.column("part").to_numpy()
            nodes, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
            x = _matrix(group.column("vector"), np.float64)
            linked = x @ x.T >= threshold
            np.fill_diagonal(linked, False)
            if i != j:
                linked &= part[:, None] != part[None, :]
            first = np.where(linked.any(1), nodes[np.argmax(linked, 1)], nodes)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(linked @ copies), pa.array(first)], names=["node", "links", "other"])

    return count


def _lists(edges: DataFrame, sizes: DataFrame | None) -> DataFrame:
    """The nearest of each node, as many as its list holds, with their rank."""
    unique = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    nearest = Window.partitionBy("a").orderBy(F.col("sim").desc(), "b")
    ranked = unique.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= MOST_LIST)
    if sizes is None:
        return ranked.where(F.col("rank") <= LIST)
    return ranked.join(sizes, "a", "left").where(F.col("rank") <= F.coalesce("size", F.lit(LIST))).drop("size")


def _descend(spark: SparkSession, vectors: DataFrame, lists: DataFrame, threshold: float, turn: int) -> DataFrame:
    """One round: neighbours of each node meet there. Reverse lists are sampled to twice a list's size, anew in each round."""
    farthest = lists.groupBy("a").agg(F.min("sim").alias("least"), F.count("*").alias("n"))
    farthest = farthest.select(F.col("a").alias("node"), F.when(F.col("n") >= LIST, F.col("least")).otherwise(-2.0).cast("float").alias("least"))
    chance = Window.partitionBy("b").orderBy(F.xxhash64("a", F.lit(turn)), "a")
    back = lists.withColumn("r", F.row_number().over(chance)).where(F.col("r") <= 2 * LIST)
    met = lists.select(F.col("a").alias("at"), F.col("b").alias("node")).unionByName(back.select(F.col("b").alias("at"), F.col("a").alias("node")))
    met = met.unionByName(lists.select(F.col("a").alias("at"), F.col("a").alias("node"))).distinct()
    rows = met.join(vectors.select("node", "half").join(farthest, "node", "left"), "node")
    rows = rows.select("at", "node", "half", F.coalesce("least", F.lit(-2.0).cast("float")).alias("least"))
    rows = rows.repartition(shuffle_partitions(spark), "at").sortWithinPartitions("at", "node")
    found = rows.mapInArrow(_nearest(["at"], LIST // 2, threshold), "a long, b long, sim float")
    return lists.select("a", "b", "sim").unionByName(found)


def _tables(count: int, threshold: float) -> tuple[int, int]:
    """Bits of a table, and the tables in one of which a pair at the threshold meets but for a chance of ``MISSED``."""
    bits = max(1, math.ceil(math.log2(max(2.0, count / (TABLE_BLOCK / 2)))))
    together = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return bits, 1 if together >= 1 else max(1, math.ceil(math.log(MISSED) / math.log1p(-together)))


def _paired(rows: DataFrame, block: int) -> DataFrame:
    """``rows`` (with ``node`` and ``rows``, the size of their bucket) once for each pair of parts (i, j) of the bucket that they are in."""
    blocks = F.ceil(F.col("rows") / block).cast("int")
    met = rows.withColumn("blocks", blocks).withColumn("part", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")).drop("rows", "blocks", "other")


def _first_graph(spark: SparkSession, vectors: DataFrame, count: int, threshold: float, seed: int) -> DataFrame:
    bits, tables = _tables(count, threshold)
    codes = vectors.select("node", "half").mapInArrow(_codes(seed, tables, bits), "node long, table int, code long")
    sizes = codes.groupBy("table", "code").agg(F.count("*").alias("rows")).where("rows > 1")
    keys = ["table", "code", "i", "j"]
    met = _paired(codes.join(sizes, ["table", "code"]), BLOCK).join(vectors.select("node", "half"), "node")
    met = met.repartition(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys, "node")
    return met.mapInArrow(_nearest(keys, LIST // 2, threshold), "a long, b long, sim float")


def _compared(spark: SparkSession, vectors: DataFrame, count: int, threshold: float) -> DataFrame:
    """Edges that connect what the links of all vectors connect, from comparing all with all."""
    keys = ["i", "j", "length"]
    met = _paired(vectors.select("node", "half", F.octet_length("half").alias("length"), F.lit(count).alias("rows")), WHOLE_BLOCK)
    met = met.repartition(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys, "node")
    return met.mapInArrow(_nearest(keys, LIST // 2, threshold), "a long, b long, sim float")


def _confirmed(vectors: DataFrame, edges: DataFrame, threshold: float) -> DataFrame:
    """The edges that are links in double precision."""
    likely = edges.where(F.col("sim") >= threshold - SLACK).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = vectors.select(F.col("node").alias("a"), F.col("vector").alias("va"))
    right = vectors.select(F.col("node").alias("b"), F.col("vector").alias("vb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _by_length(whole, 2):
                same = (_matrix(batch.column(2), np.float64) * _matrix(batch.column(3), np.float64)).sum(1)
                yield batch.select(["a", "b"]).filter(pa.array(same >= threshold))

    return likely.join(left, "a").join(right, "b").select("a", "b", "va", "vb").mapInArrow(check, "a long, b long")


def _audited(spark: SparkSession, vectors: DataFrame, groups: DataFrame) -> DataFrame:
    """The ``AUDIT_ROWS`` vectors with the smallest hashes (``alone`` 0), and as many of those with the smallest id of their component (1)."""
    one_each = vectors.join(groups.where("node <> component").select("node"), "node", "left_anti")
    chosen = [rows.orderBy(F.xxhash64("node", F.lit(5 + n)), "node").limit(AUDIT_ROWS).select("node", "vector", F.lit(n).alias("alone")) for n, rows in enumerate((vectors, one_each))]
    return stored(spark, chosen[0].unionByName(chosen[1]), "audited")


def _audit(spark: SparkSession, vectors: DataFrame, audited: DataFrame, threshold: float) -> DataFrame:
    """All links (a, b) of the audited vectors."""
    sample = audited.select("node", "vector").dropDuplicates(["node"]).collect()
    by_length: dict[int, list] = {}
    for r in sample:
        by_length.setdefault(len(r["vector"]), []).append((r["node"], np.frombuffer(r["vector"])))
    held = spark.sparkContext.broadcast({n: (np.array([i for i, _ in rows]), np.array([v for _, v in rows])) for n, rows in by_length.items()})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _by_length(whole, 1)):
            nodes, vectors = batch.column(0).to_numpy(), _matrix(batch.column(1), np.float64)
            ids, x = held.value.get(8 * vectors.shape[1], ((), None))
            if len(ids):
                at = np.nonzero((vectors @ x.T >= threshold) & (nodes[:, None] != ids[None, :]))
                yield pa.RecordBatch.from_arrays([pa.array(ids[at[1]]), pa.array(nodes[at[0]])], names=["a", "b"])

    return vectors.select("node", "vector").mapInArrow(compare, "a long, b long")


def _recall(audited: DataFrame, truth: DataFrame, groups: DataFrame) -> float:
    """The share of an audited vector's links that lie within its component, in the mean of each sample's linked vectors; the lower mean."""
    of_a = groups.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    of_b = groups.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    known = truth.join(of_a, "a", "left").join(of_b, "b", "left").select("a", F.coalesce(F.col("ca") == F.col("cb"), F.lit(False)).cast("double").alias("known"))
    each = known.groupBy("a").agg(F.avg("known").alias("known"))
    means = audited.select(F.col("node").alias("a"), "alone").join(each, "a").groupBy("alone").agg(F.avg("known").alias("mean"))
    return means.agg(F.coalesce(F.min("mean"), F.lit(1.0))).first()[0]


def linked_vectors(spark: SparkSession, embeddings: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept and audit_recall (see ``_recall``; before what the audit added)."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = stored(spark, rows.mapInArrow(_unit, "vec_id long, vector binary, half binary"), "unit-vectors")
    usable = rows.where("vec_id IS NOT NULL AND vector IS NOT NULL").dropDuplicates(["vec_id", "vector"])
    classes = usable.groupBy("vector", "half").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    classes = stored(spark, classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    count = classes.count()

    edges = stored(spark, _first_graph(spark, classes, count, threshold, 11), "graph")
    sizes, truth, before = None, None, None
    turn = 0
    for attempt in range(1 + MORE_ROUNDS):
        for step in range(MOST_ROUNDS):
            lists = stored(spark, _lists(edges, sizes), "lists")
            linked = lists.where(F.col("sim") >= threshold - SLACK).select("a", "b")
            if before is not None and step >= ROUNDS and linked.join(before, ["a", "b"], "left_anti").count() <= FEW * linked.count():
                break
            before = linked
            full = lists.groupBy("a").agg(F.count("*").alias("n"), F.min("sim").alias("least")).where(F.col("least") >= threshold - SLACK)
            full = full.where(F.col("n") >= LIST).select("a", F.least(2 * F.col("n"), F.lit(MOST_LIST)).cast("int").alias("size"))
            sizes = stored(spark, full, "saturated")
            found = _descend(spark, classes, lists, threshold, turn)
            edges = stored(spark, found.unionByName(edges.where(F.col("sim") >= threshold - SLACK)).groupBy("a", "b").agg(F.max("sim").alias("sim")), "graph")
            turn += 1
        links = stored(spark, _confirmed(classes, edges, threshold), "links")
        groups = stored(spark, components(spark, links), "groups")
        if truth is None:
            audited = _audited(spark, classes, groups)
            truth = stored(spark, _audit(spark, classes, audited, threshold), "audit")
        recall = _recall(audited, truth, groups)
        if recall >= WANTED_RECALL:
            break
        if attempt < MORE_ROUNDS:
            edges = stored(spark, edges.unionByName(_first_graph(spark, classes, count, threshold, 100 + attempt)), "graph")
    if recall < WANTED_RECALL:
        edges = stored(spark, _compared(spark, classes, count, threshold), "compared")
        links = stored(spark, _confirmed(classes, edges, threshold), "links")
        recall = _recall(audited, truth, components(spark, links))
    # An id with several vectors is several nodes that belong together.
    several = usable.groupBy("vec_id").agg(F.min("vector").alias("lo"), F.max("vector").alias("hi")).where("lo <> hi")
    own = usable.join(several.select("vec_id"), "vec_id").select("vec_id", "vector").join(classes.select("vector", "node"), "vector")
    first = own.groupBy("vec_id").agg(F.min("node").alias("a"))
    links = links.unionByName(truth.select("a", "b")).unionByName(own.join(first, "vec_id").select("a", F.col("node").alias("b")))
    groups = stored(spark, components(spark, links), "groups")

    sized = groups.groupBy("component").agg(F.count("*").alias("rows"))
    met = _paired(groups.join(sized, "component"), BLOCK)
    keys = ["component", "i", "j", "length"]
    met = met.join(classes.select("node", "copies", "vector", F.octet_length("vector").alias("length")), "node").repartition(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys, "node")
    # A component of several blocks holds the pairs within a block once, under i = j.
    counted = met.mapInArrow(_count(threshold), "node long, links long, other long")
    counted = counted.groupBy("node").agg(F.sum("links").alias("links"))

    names = groups.join(classes.select("node", "least_id"), "node").groupBy("component").agg(F.min("least_id").alias("name"))
    named = classes.select("vector", "node", "copies", "least_id").join(counted, "node", "left").join(groups, "node", "left").join(names, "component", "left")
    named = named.select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("name", "least_id").alias("component"))
    out = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("vector")).alias("vector")).join(named, "vector", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
        F.lit(recall).alias("audit_recall"),
    )
