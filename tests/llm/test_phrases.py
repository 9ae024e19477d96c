"""Phrase mining against a plain count of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from meterlake.llm import collocations


def plain(rows, least, top, percent=80):
    grams, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    grams[lang, tuple(words[i : i + k])] += 1
    f = {key: c for key, c in grams.items() if c >= least}
    covered = set()
    for (lang, p), c in f.items():
        for k in range(2, len(p)):
            covered |= {(lang, p[i : i + k]) for i in range(len(p) - k + 1) if 100 * c >= percent * f[lang, p[i : i + k]]}
    out = []
    for lang in {key[0] for key in f}:
        scored = []
        for (other, p), a in f.items():
            if other != lang or len(p) < 2 or (lang, p) in covered:
                continue
            score, _, left, right = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def rows_of(frame):
    return sorted(map(tuple, frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


SCHEMA = "doc_id long, lang string, text string, words array<string>, run int, n int, f string, id string"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = ["der", "The", "the", "x", "ßa", "été", "ÉTÉ", "日本", "a-b", "'", "no\xa0break", "q r"]
    rows = [("en", " ".join(rng.choice(words[:5]) + rng.choice(["", "", "", ".", ",", "\n", "\t", "\x0b", " ;"]) for _ in range(300))) for _ in range(30)]
    rows += [(rng.choice([None, "und", "de", ""]), " ".join(rng.choice(words) for _ in range(60))) for _ in range(60)]
    rows += [("en", "same words once more here"), *[("fr", "le chat noir dort bien. Le chat noir")] * 40]
    rows += [("en", None), (None, ""), ("en", " \t. ,\n"), ("en", "."), ("de", "long " * 20_000), ("en", "y" * 30_000), ("en", "end"), ("en", "start")]
    return rows


@pytest.mark.parametrize("small", [collocations.SMALL_GROUPS, 0])
def test_phrases_equal_a_plain_count(spark, texts, small, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE_BYTES", 4096)
    monkeypatch.setattr(collocations, "HELD_PAIRS", 50)
    frame = spark.createDataFrame([(i % 7 or None, *r, None, 1, 2, "f", "i") for i, r in enumerate(texts)], SCHEMA).repartition(3)
    found = rows_of(collocations.collocations(spark, frame, least=3, top=40, small=small))
    assert found == plain(texts, 3, 40)
    assert {r[0] for r in found} == {"en", "de", "fr", "und", ""}


def test_phrases_of_nothing(spark):
    assert rows_of(collocations.collocations(spark, spark.createDataFrame([], SCHEMA))) == []
    few = spark.createDataFrame([(1, "en", "too few words", None, 1, 2, "f", "i")], SCHEMA)
    assert rows_of(collocations.collocations(spark, few)) == []


def test_scores_are_exact_past_64_bits(spark):
    """The score's expression on counts whose products do not fit a long."""
    a, left, right = 9_000_000_000_000_001, 9_000_000_000_000_003, 9_000_000_000_000_007
    row = spark.sql(
        f"SELECT (CAST(2000000 AS DECIMAL(7,0)) * CAST({a}L AS DECIMAL(20,0))) div (CAST({left}L AS DECIMAL(20,0)) + CAST({right}L AS DECIMAL(20,0))) AS s"
    ).first()
    assert row["s"] == 2000000 * a // (left + right)
