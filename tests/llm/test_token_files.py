"""Token files against whole-text encoding by the same library."""

from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from meterlake.llm import token_files
from meterlake.llm.part_cache import PartCache
from meterlake.session import scratch_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, shard int, row long, ids string, start long, h long"


def tokenizer():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def texts():
    rng = random.Random(12)
    bits = ["a", "b's", " ", "  ", "\n", " \n", "\t ", "é", "日本", "1 2", "　", "\x85 x", "\x1c ", "don't", "<|endoftext|>", "…", "\xa0"]
    rows = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randrange(40))) for _ in range(300)]
    return [None, "", " ", "  ", "\n ", " a", "a ", "a  b", "word " * 60_000, "x" * 20_000, *rows]


def encoder():
    with open(PATH, encoding="utf-8") as held:
        return token_files.Encoder(held.read())


def expected(rows):
    made, start, out = tokenizer(), 0, []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc_id, text in order:
        ids = [*made.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def frame_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "ids", 3, 4) for i, t in rows], SCHEMA).repartition(5)


def test_files_hold_what_the_library_gives(spark, monkeypatch):
    monkeypatch.setattr(token_files, "KEYS_PER_INDEX", 50)
    monkeypatch.setattr(token_files, "READ_BYTES", 2000)
    rows = [(i * 37 % 1009 - 500, t) for i, t in enumerate(texts())] + [(None, "no id")]
    folder = scratch_dir(spark, "ids")
    frame = frame_of(spark, rows)
    found = token_files.filed_and_read(spark, frame, folder, PATH)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected(rows), key=repr)
    # Keyed access: some keys, some of them strangers.
    keys = spark.createDataFrame([(rows[5][0],), (10**12,), (None,), (7_777,)], "doc_id long")
    assert token_files.layout_of(spark, folder) == ("<u2", 7)
    some = token_files.looked_up(spark, keys, folder).collect()
    assert {r["doc_id"] for r in some} == {rows[5][0], None}
    made = tokenizer()
    assert np.frombuffer(next(r["ids"] for r in some if r["doc_id"] is None), "<u2").tolist() == [*made.encode("no id", add_special_tokens=False).ids, 0]


def test_repeated_ids_come_back_from_all_shards(spark):
    rng = random.Random(3)
    rows = [(5, f"copy {rng.random()}") for _ in range(400)] + [(5, "same")] * 300 + [(i, "") for i in range(20)] + [(None, None)] * 3
    found = token_files.filed_and_read(spark, frame_of(spark, rows), scratch_dir(spark, "ids"), PATH)
    got = sorted(map(tuple, found.collect()), key=lambda r: r[1])
    made, want = tokenizer(), sorted(expected(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r[0] for r in got] == [r[0] for r in want]
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in want)
    ends = np.cumsum([r[2] for r in got]).tolist()
    assert [r[1] for r in got] == [0, *ends[:-1]]
    assert made.get_vocab_size() < 1 << 16 and token_files.id_kind(PATH) == "<u2"


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_a_column_of_texts(kind):
    made, rows = tokenizer(), [t or "" for t in texts()]
    want = [[*made.encode(t, add_special_tokens=False).ids, 0] for t in rows]
    column = pa.array(["not in the slice", *rows], kind).slice(1)
    ids, lengths = encoder().encode(column)
    assert np.frombuffer(ids, "<u2").tolist() == sum(want, []) and lengths.tolist() == [len(w) for w in want]


def test_no_python_object_for_each_word():
    """What a word costs in Python decides the CPU time; strings and lists of words took 104 bytes a word."""
    words, column, made = 200_000, pa.array(["word " * 100_000] * 2), encoder()
    made.encode(column.slice(0, 1))
    tracemalloc.start()
    made.encode(column)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40 * words


def test_no_documents(spark):
    assert token_files.filed_and_read(spark, spark.createDataFrame([], SCHEMA), scratch_dir(spark, "ids"), PATH).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30_000])
def test_perfect_hash(n):
    hashes = np.unique(np.random.default_rng(n).integers(0, 2**64, n, np.uint64))
    entries = np.zeros(len(hashes), token_files._SLOT)
    entries["first_row"] = np.arange(len(hashes))
    perfect, slots = token_files.read_index(token_files.index_bytes(hashes, (hashes >> np.uint64(7)).astype(np.uint32), entries))
    found = perfect.slots(hashes)
    assert sorted(found.tolist()) == list(range(len(hashes)))
    assert slots["first_row"][found].tolist() == list(range(len(hashes)))
    with pytest.raises(ValueError):
        token_files.PerfectHash.build(np.zeros(2, np.uint64))


def test_cache_keeps_what_is_used():
    asked = []

    def compute(parts):
        asked.extend(parts)
        return [p * 2 for p in parts]

    cache = PartCache(compute, 10)
    for i in range(100):
        results = cache.results({"hot", f"cold{i}"})
        assert results["hot"] == "hothot"
    assert asked.count("hot") == 1 and len(cache.young) + len(cache.old) <= 24


def test_writing_again_changes_nothing(spark):
    """Files depend on the documents alone; nothing is left under a task's own name."""
    from pathlib import Path

    folder = scratch_dir(spark, "ids")
    frame = frame_of(spark, [(i, f"text {i}") for i in range(50)]).coalesce(1)
    token_files.write_shards(spark, frame, folder, PATH)
    first = {p.name: p.read_bytes() for p in Path(folder.removeprefix("file://")).glob("shard-*")}
    again = scratch_dir(spark, "ids")
    token_files.write_shards(spark, frame, again, PATH)
    assert {p.name: p.read_bytes() for p in Path(again.removeprefix("file://")).glob("shard-*")} == first
