"""Exact dedup: compressed radix tries own the texts of a length-and-hash partition.

Each task first inserts its own texts into a trie, so a text travels once per task however often
it is repeated there. Partitions by (byte length, 64-bit content hash) then insert the full byte strings into their
trie; a terminal node keeps the first owner, the smallest id and the number of rows, whatever is inserted how often. A later owner
leaves the task as a link to the first one, and a join gives it what the terminal holds. Subtrees are spilled to
task-private files when a trie outgrows its limit and are finished one by one afterwards. Two texts meet in one terminal node only if
all bytes agree, so neither hash decides.

Defined results: a null text counts as empty; a null doc_id is never the smallest, unless no row of
the group has another; repeated rows are members of their group like any other; an empty table gives no rows.
"""

from __future__ import annotations

import os
import pickle
import sys
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import SPACE, pieces, stored, whole_text

#: Bytes of labels that a trie holds before it spills.
TRIE_BYTES = 64 << 20
#: Bytes of text that a task gathers before it hands on one row for each distinct text.
GATHER_BYTES = 16 << 20


class _Node:
    __slots__ = ("label", "children", "value", "spilled")

    def __init__(self, label: bytes) -> None:
        self.label = label
        self.children: dict[int, _Node] = {}
        #: First owner, smallest id, rows.
        self.value: list | None = None
        self.spilled: str | None = None


class Trie:
    """A compressed radix trie from byte strings to (first owner, smallest id, rows).

    ``links`` gains (owner, first owner) for every owner that meets an earlier one; whoever fills the trie empties it.
    """

    def __init__(self, most_bytes: int = TRIE_BYTES, links: list[tuple[int, int]] | None = None) -> None:
        self.root = _Node(b"")
        self.links = [] if links is None else links
        self.bytes = 0
        self.most = most_bytes
        self.folder: tempfile.TemporaryDirectory | None = None
        self.files = 0

    def insert(self, key: bytes, owner: int, least: int | None, rows: int) -> list | None:
        """The terminal's values after the insertion; None if the key went to a spilled subtree."""
        node, at = self.root, 0
        while True:
            if node.spilled:
                with open(node.spilled, "ab") as out:
                    pickle.dump((key[at:], [owner, least, rows]), out)
                return None
            if at == len(key):
                if node.value is None:
                    node.value = [owner, least, rows]
                else:
                    held = node.value
                    self.links.append((owner, held[0]))
                    if least is not None and (held[1] is None or least < held[1]):
                        held[1] = least
                    held[2] += rows
                return node.value
            child = node.children.get(key[at])
            if child is None:
                child = _Node(key[at:])
                value = child.value = [owner, least, rows]
                node.children[key[at]] = child
                self.bytes += len(child.label) + 200
                if self.bytes > self.most:
                    self._spill()
                return value
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            shared = len(os.path.commonprefix([label, key[at : at + len(label)]]))
            middle = _Node(label[:shared])
            child.label = label[shared:]
            middle.children[child.label[0]] = child
            node.children[middle.label[0]] = middle
            self.bytes += 200
            node, at = middle, at + shared

    def _spill(self) -> None:
        """Move the subtrees below the root to files; later keys of a subtree go straight to its file."""
        if self.folder is None:
            self.folder = tempfile.TemporaryDirectory(prefix="trie-")
        for child in self.root.children.values():
            if child.spilled:
                continue
            self.files += 1
            path = os.path.join(self.folder.name, str(self.files))
            with open(path, "wb") as out:
                for suffix, value in _walk(child, b"", False):
                    # A subtree spilled before, below a node that was split since, moves along.
                    for key, more in _read(value) if isinstance(value, str) else [(b"", value)]:
                        pickle.dump((suffix + key, more), out)
            child.spilled, child.children, child.value = path, {}, None
        self.bytes = 0

    def items(self) -> Iterator[tuple[bytes, list]]:
        """Every key with its values; spilled subtrees are read back one at a time.

        A file holds the entries of a key in the order they came, so the first owner stays the first.
        """
        for suffix, value in _walk(self.root, b"", True):
            if isinstance(value, str):
                below = Trie(self.most, self.links)
                for key, more in _read(value):
                    below.insert(key, *more)
                for rest, found in below.items():
                    yield suffix + rest, found
            else:
                yield suffix, value
        if self.folder is not None:
            self.folder.cleanup()


def _read(path: str) -> Iterator[tuple[bytes, list]]:
    """The entries of a spilled subtree; the file goes."""
    with open(path, "rb") as held:
        while True:
            try:
                yield pickle.load(held)
            except EOFError:
                break
    os.remove(path)


def _walk(top: _Node, prefix: bytes, labelled: bool) -> Iterator[tuple[bytes, list | str]]:
    """Keys below ``top`` (without its label unless ``labelled``), or the file of a spilled subtree."""
    stack = [(top, prefix + (top.label if labelled else b""))]
    while stack:
        node, key = stack.pop()
        if node.spilled:
            yield key, node.spilled
            continue
        if node.value is not None:
            yield key, node.value
        stack.extend((child, key + child.label) for child in node.children.values())


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each row, under ``owner``; the first row of each text also carries the text."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("sha", pa.string()), ("owner", pa.int64()), ("hash", pa.int64()), ("text", pa.binary()), ("least", pa.int64()), ("members", pa.int64())])
    # Bounded by what is gathered, so nothing spills here.
    trie, rows, size = Trie(sys.maxsize), [], 0

    def flush() -> pa.RecordBatch:
        texts = {found[0]: (key, found[1], found[2]) for key, found in trie.items()}
        out = [
            (row, doc, sha, held[0], hashed, *(texts[row] if row == held[0] else (None, None, None)))
            for row, doc, sha, hashed, held in rows
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    for batch in pieces(batches, "text"):
        columns = batch.to_pydict()
        for row, doc, sha, hashed, text in zip(*[columns[c] for c in ("row", "doc_id", "sha", "hash", "text")], strict=True):
            rows.append((row, doc, sha, hashed, trie.insert(text, row, doc, 1)))
            size += len(text) + 300
        if size > GATHER_BYTES:
            yield flush()
            trie, rows, size = Trie(sys.maxsize), [], 0
    if rows:
        yield flush()


def _owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row with the smallest id and the number of rows for each text, under its first owner; (owner, first) for other owners."""
    schema = pa.schema([("owner", pa.int64()), ("first", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
    trie = Trie()
    out: list[tuple] = []

    def full(least: int) -> Iterator[pa.RecordBatch]:
        out.extend((owner, first, None, None) for owner, first in trie.links)
        trie.links.clear()
        if len(out) > least:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)
            out.clear()

    for batch in batches:
        columns = batch.to_pydict()
        for owner, text, least, members in zip(*[columns[c] for c in ("owner", "text", "least", "members")], strict=True):
            trie.insert(text, owner, least, members)
        yield from full(50_000)
    for _, (first, least, total) in trie.items():
        out.append((first, first, least, total))
        if len(out) + len(trie.links) > 50_000:
            yield from full(0)
    yield from full(0)


def exact_groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row; texts equal up to white space are one group.

    ``row`` is a number of each row within this run.
    """
    text = F.regexp_replace(whole_text(), SPACE, " ")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("row", "doc_id", F.sha2("text", 256).alias("sha"), F.xxhash64(F.octet_length("text"), F.col("text")).alias("hash"), F.encode("text", "utf-8").alias("text"))
    gathered = rows.mapInArrow(
        _gathered, "row long, doc_id long, sha string, owner long, hash long, text binary, least long, members long"
    )
    gathered = stored(spark, gathered, "exact-rows")
    texts = gathered.where("text IS NOT NULL").select("owner", "hash", "text", "least", "members")
    owned = texts.repartition(F.octet_length("text"), "hash").select("owner", "text", "least", "members")
    # The first owner of a text answers for itself, so only repeated texts travel once more.
    found = stored(spark, owned.mapInArrow(_owned, "owner long, first long, keep_id long, group_size long"), "exact-owners")
    terminals = found.where("owner = first").select("first", "keep_id", "group_size")
    others = found.where("owner <> first").select("owner", "first")
    groups = terminals.withColumnRenamed("first", "owner").unionByName(others.join(terminals, "first").drop("first"))
    out = gathered.select("row", "doc_id", "sha", "owner").join(groups, "owner")
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return out.select("row", "doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"))


def distinct_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay; of rows repeated under the kept id, the first.

    A row is found again by its id and the digest of its text, which moves no text that goes.
    """
    groups = exact_groups(spark, docs).where("kept")
    keep = groups.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("same"))
    marked = docs.withColumn("__sha", F.sha2(F.regexp_replace(whole_text(), SPACE, " "), 256))
    keep = keep.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__keep"), "same")
    out = marked.join(keep, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__sha") == F.col("__keep")))
    once = out.where("same = 1")
    again = out.where("same > 1").dropDuplicates(["__id", "__keep"])
    return once.unionByName(again).select(*docs.columns)
