"""Byte-level BPE by dynamic programming over prefixes.

Every prefix of a byte string has one encoding, and so one last token. A token may follow a prefix if
merging would never have crossed the seam between the prefix's last token and it; exactly one of the tokens that
end at a place may. So the last tokens of all prefixes are a table that grows by appending, and after
an edit it is computed anew only until it agrees with the old one again.

Defined results: a null text counts as empty and has no tokens; rows repeated give a row each; a null
doc_id is kept; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import pieces, whole_text
from meterlake.llm.part_cache import PartCache

#: Parts, and pieces of them, kept from batch to batch, in each of two generations. Only speed depends on it.
CACHE_ENTRIES = 80_000
FITS_ENTRIES = 300_000
_NEVER = 1 << 60


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: a base64 token and its rank on each line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class Vocabulary:
    """Tokens, how each was merged, and which two may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.longest = max(map(len, ranks))
        self.lengths: dict[bytes, list[int]] = {}  # by the last four bytes: lengths of tokens over four bytes
        self._fits: dict[int, bool] = {}
        self._endings: dict[bytes, tuple[tuple[int, int | None], ...]] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 4 and len(token) not in (known := self.lengths.setdefault(token[-4:], [])):
                known.append(len(token))
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut], _NEVER), ranks.get(token[cut:], _NEVER)
                if a < rank and b < rank and self._seam_holds(a, b, rank):
                    self.left[rank], self.right[rank] = a, b
                    break

    def _seam_holds(self, a: int, b: int, below: int = _NEVER) -> bool:
        """Whether no merge of rank under ``below`` crosses from a to b.

        Merges happen in order of rank. Undoing them from the last one on shows each pair of parts that ever
        met at the seam; such a pair merges if its own rank comes before the merges that used up its
        parts (of equal ranks the one further left is first).
        """
        ranks, bytes_of, left, right = self.ranks, self.bytes_of, self.left, self.right
        until_a = until_b = below
        while True:
            merged = ranks.get(bytes_of[a] + bytes_of[b])
            if merged is not None and merged < until_a and (merged <= until_b if until_b != below else merged < below):
                return False
            made_a = a if a in left else -1
            made_b = b if b in left else -1
            if made_a < 0 and made_b < 0:
                return True
            if made_b >= made_a:
                until_b, b = b, left[b]
            else:
                until_a, a = a, right[a]

    def _ending(self, tail: bytes) -> tuple[tuple[int, int | None], ...]:
        """Length and rank of the tokens that may end a string with these last four bytes (or fewer, if it has no more).

        A longer token depends on bytes before, so its rank is open. Only one token is right, so lengths stand as they are likely.
        """
        short = [(n, self.ranks[tail[-n:]]) for n in (3, 2, 4) if n <= len(tail) and tail[-n:] in self.ranks]
        if len(self._endings) > FITS_ENTRIES:
            self._endings.clear()
        found = self._endings[tail] = (*short, *((n, None) for n in self.lengths.get(tail, ())), (1, self.ranks[tail[-1:]]))
        return found

    def extend(self, data: bytes, last: list[int], stop: int | None = None) -> None:
        """Add the last tokens of the prefixes of ``data`` that ``last`` lacks, up to ``stop`` bytes."""
        ranks, fits, endings = self.ranks, self._fits, self._endings
        for end in range(len(last), (len(data) if stop is None else stop) + 1):
            tail = data[end - 4 : end] if end > 4 else data[:end]
            for length, token in endings.get(tail) or self._ending(tail):
                start = end - length
                if token is None:
                    if start < 0 or (token := ranks.get(data[start:end])) is None:
                        continue
                if not start:
                    break
                pair = last[start] << 32 | token
                holds = fits.get(pair)
                if holds is None:
                    if len(fits) > FITS_ENTRIES:
                        fits.clear()
                    holds = fits[pair] = self._seam_holds(last[start], token)
                if holds:
                    break
            else:
                raise ValueError(f"no token ends at byte {end}")
            last.append(token)

    def prefixes(self, data: bytes) -> list[int]:
        """The last token of each prefix; entry 0 stands for the empty one."""
        last = [-1]
        self.extend(data, last)
        return last

    def ids(self, last: list[int]) -> list[int]:
        """The encoding of the longest prefix of a table."""
        out, end = [], len(last) - 1
        while end:
            out.append(last[end])
            end -= len(self.bytes_of[last[end]])
        return out[::-1]

    def encode(self, data: bytes) -> list[int]:
        return self.ids(self.prefixes(data))

    def encode_all(self, pieces: Iterable[str]) -> dict[str, list[int]]:
        """The encodings of many pieces: in sorted order each one's table goes on from the prefix it shares with the one before."""
        out, before, last = {}, b"", [-1]
        for piece in sorted(pieces):
            data = piece.encode()
            shared, most = 0, min(len(data), len(before))
            while shared < most and data[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :]
            self.extend(data, last)
            out[piece] = self.ids(last)
            before = data
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PrefixTable:
    """The encodings of all prefixes of one piece of text that changes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data = vocabulary, data
        self.last = vocabulary.prefixes(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.extend(self.data, self.last)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` for data[start:stop]; returns how many prefixes were computed anew.

        An entry depends on the bytes and entries of one token's length before it, so once
        that many entries in a row, all past the edit, are as before, the rest is.
        """
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        last, reach, same = old[: start + 1], self.vocabulary.longest, 0
        for end in range(start + 1, len(self.data) + 1):
            self.vocabulary.extend(self.data, last, end)
            past = end - shift > stop
            same = same + 1 if past and last[end] == old[end - shift] else 0
            if same > reach:
                self.last = last + old[end - shift + 1 :]
                return end - start
        self.last = last
        return len(self.data) - start

    def ids(self, end: int | None = None) -> list[int]:
        return self.vocabulary.ids(self.last if end is None else self.last[: end + 1])


class Encoder:
    """Texts to ids: each match of the pattern is encoded by itself.

    The pattern never matches across a space between two other characters, save at the space itself. So what stands between
    such spaces is a part looked up by itself; of a new part only the matches that were not met lately are encoded.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        self.vocabulary = vocabulary
        self.find = regex.compile(pattern).findall
        self.odd = regex.compile(r"\s ").search
        self.names = {r: f" {r}" for r in vocabulary.bytes_of}
        self.pieces = PartCache(self._coded, CACHE_ENTRIES)
        self.parts = PartCache(self._joined, CACHE_ENTRIES)

    def _matches(self, part: str) -> list[str]:
        """The pattern's matches in a space and ``part``; letters, and letters before one mark, need no search."""
        if part.isalpha():
            return [" " + part]
        if part and part[-1] in ".,;:" and part[:-1].isalpha():
            return [" " + part[:-1], part[-1]]
        return self.find(" " + part)

    def _coded(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        """Of each piece: its ids in decimal, each after a space, and the bytes that they decode to."""
        encodings = self.vocabulary.encode_all(pieces)
        for piece in pieces:
            ids = encodings[piece]
            yield "".join(map(self.names.__getitem__, ids)), self.vocabulary.decode(ids)

    def _joined(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        matches = list(map(self._matches, parts))
        coded = self.pieces.results(set(chain.from_iterable(matches)))
        for pieces in matches:
            yield self._together([coded[p] for p in pieces])

    @staticmethod
    def _together(rows: list[tuple[str, bytes]]) -> tuple[str, bytes]:
        return rows[0] if len(rows) == 1 else ("".join([r[0] for r in rows]), b"".join([r[1] for r in rows]))

    def encode(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Of each text: its ids in decimal, each after a space, and the bytes that they decode to."""
        plans, wanted, heads = [], set(), set()
        for text in texts:
            if self.odd(text):
                head, parts = self.find(text), []
            else:
                first, *parts = text.split(" ")
                head = self.find(first)
                wanted.update(parts)
            heads.update(head)
            plans.append((head, parts))
        known = self.parts.results(wanted)
        coded = self.pieces.results(heads)
        for head, parts in plans:
            yield self._together([*[coded[p] for p in head], *map(known.__getitem__, parts)])


@lru_cache(maxsize=2)
def _encoder(ranks: bytes, pattern: str) -> Encoder:
    return Encoder(Vocabulary(read_ranks(ranks)), pattern)


def encoded(spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, digests of ids and of the decoded bytes; with ``with_ids`` also the ids.

    The driver reads the rank file, of a fixed size, and sends its bytes once to each executor.
    """
    with open(ranks_path, "rb") as held:
        ranks = spark.sparkContext.broadcast(held.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value, pattern)
        gc.disable()  # the caches hold many small tuples and no cycles
        try:
            yield from encode_batches(encoder, batches)
        finally:
            gc.enable()

    def encode_batches(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 2 << 20):
            rows = []
            for listed, whole in encoder.encode(batch.column(1).to_pylist()):
                row = (listed.count(" "), hashlib.sha256(listed[1:].encode()).hexdigest(), hashlib.sha256(whole).hexdigest())
                rows.append((*row, list(map(int, listed.split()))) if with_ids else row)
            kinds = [pa.int64(), pa.string(), pa.string(), *([pa.list_(pa.int32())] if with_ids else [])]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return texts.mapInArrow(encode, schema)
