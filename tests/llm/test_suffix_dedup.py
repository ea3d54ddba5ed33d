import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonegauge.llm import blocks, suffix_dedup


def brute(texts, length):
    """(removed, runs, kept) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((int(gone.sum()), runs, bytes(np.frombuffer(d, np.uint8)[~gone])))
    return out


def check(spark, texts, length):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: r for r in suffix_dedup.remove_repeats(rows, length=length).collect()}
    assert len(got) == len(texts)
    for i, (removed, runs, kept) in enumerate(brute(texts, length)):
        assert (got[i].n_removed, got[i].n_spans, bytes(got[i].kept)) == (removed, runs, kept), i
        assert sum(s.end - s.start for s in got[i].spans) == removed


@pytest.mark.parametrize("length", [1, 5, 30, 80, 400])
def test_cover_has_every_difference(length):
    period, residues = suffix_dedup.cover(length)
    assert {(a - b) % period for a in residues for b in residues} == set(range(period))
    assert period <= max(1, length // 2)


@pytest.mark.parametrize("length", [3, 40, 100])
def test_like_brute_force(spark, length):
    rng = random.Random(length)
    passage = "".join(rng.choices("abcd", k=3 * length))
    texts = ["".join(rng.choices("ab", k=rng.randint(0, 3 * length))) for _ in range(40)]
    texts += [texts[0] + passage[k : k + 2 * length] + texts[k % 7] for k in range(0, length, max(1, length // 9))]
    texts += [None, "", passage, passage, "é" * length, "x" * (2 * length)]
    check(spark, texts, length)


def brute_words(texts, length, words):
    """What is left of each text where strings of ``length`` bytes and of ``words`` words that repeat are removed."""
    data = [(t or "").encode() for t in texts]
    places = [[(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0d]+", d)] for d in data]
    window = lambda d, p, k: tuple(d[a:b] for a, b in p[k : k + words])
    seen = Counter(window(d, p, k) for d, p in zip(data, places, strict=True) for k in range(len(p) - words + 1))
    bytes_ = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d, p in zip(data, places, strict=True):
        gone = np.zeros(len(d), bool)
        for k in range(len(p) - words + 1):
            if seen[window(d, p, k)] > 1:
                gone[p[k][0] : p[k + words - 1][1]] = True
        for k in range(len(d) - length + 1):
            if bytes_[d[k : k + length]] > 1:
                gone[k : k + length] = True
        out.append(bytes(np.frombuffer(d, np.uint8)[~gone]))
    return out


@pytest.mark.parametrize("words", [1, 4, 51])
def test_words_like_brute_force(spark, words):
    rng = random.Random(words)
    some = lambda n: " ".join("".join(rng.choices("abcdé", k=rng.randint(1, 6))) for _ in range(n))
    passage = some(3 * words)
    texts = [some(rng.randint(0, 4 * words)) for _ in range(30)]
    texts += [f"{some(9)} {' '.join(passage.split()[k:])} {some(5)}" for k in range(0, 2 * words + 2, max(1, words // 8))]
    texts += [None, "", " ", passage.replace(" ", "\n\t "), f"\n{passage}", "x " * 200, "long" * 3000, "y" * 70000 + " " + passage]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: bytes(r.rest) for r in suffix_dedup.remove_repeats(rows, length=300, words=words).collect()}
    assert got == dict(enumerate(brute_words(texts, 300, words)))


def test_buckets_follow_the_bytes(spark, monkeypatch):
    """More buckets than the session's partitions give the same answer."""
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 100)
    check(spark, ["abc" * 200, "abc" * 150, "q" * 90, None, "".join(random.Random(1).choices("abcdef", k=2000))] * 2, 60)


def test_odd_rows(odd, none):
    rows = suffix_dedup.remove_repeats(odd.withColumn("_text", F.lit("x")).withColumn("text_", F.lit("y"))).drop("_text", "text_")
    assert rows.columns == ["doc_id", "score", "block", "n_bytes", "n_removed", "n_spans", "spans", "kept"]
    got = rows.collect()
    want = brute([r.text for r in odd.collect()], 400)
    assert Counter((r.n_removed, r.n_spans, hashlib.md5(r.kept).digest()) for r in got) == Counter(
        (a, b, hashlib.md5(c).digest()) for a, b, c in want
    )
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_keys_come_back():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64))
    assert (blocks.decode(blocks.encode(keys)) == keys).all()
    assert len(blocks.decode(blocks.encode(keys[:0]))) == 0
