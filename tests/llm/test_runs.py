"""Periodic runs against a search over all lags."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tonegauge.llm import periodic_runs, queries


def brute(words, shortest=12):
    """(start, end, period) of all runs, each lag scanned in ascending order."""
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] == words[i + q]:
                j = i
                while j + q < len(words) and words[j] == words[j + q]:
                    j += 1
                if j + q - i >= max(shortest, 2 * q):
                    best.setdefault((i, j + q), q)
                i = j
            i += 1
    return sorted((s, e, q) for (s, e), q in best.items())


def fast(rows):
    numbers, edges, order = periodic_runs.word_numbers([[str(w).encode() for w in r] for r in rows])
    found = periodic_runs.runs_of(numbers, edges)
    out = [[] for _ in rows]
    for k, (s, e, q) in zip((np.searchsorted(edges, found[:, 0], "right") - 1).tolist(), found.tolist(), strict=True):
        out[order[k]].append((s - int(edges[k]), e - int(edges[k]), q))
    return [sorted(o) for o in out]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue_morse(n):
    t = [0]
    while len(t) < n:
        t += [1 - v for v in t]
    return t[:n]


def broken(rng, n, period, kinds, breaks):
    base = [rng.randrange(kinds) for _ in range(period)]
    out = [base[k % period] for k in range(n)]
    for _ in range(breaks):
        out[rng.randrange(n)] = 99
    return out


def nested(rng, n):
    inner = [rng.randrange(3) for _ in range(rng.randrange(1, 9))]
    block = (inner * 80)[: rng.randrange(20, 240)] + [rng.randrange(3) for _ in range(rng.randrange(3))]
    return ((block * rng.randrange(1, 4) + [rng.randrange(3) for _ in range(rng.randrange(4))]) * 6)[:n]


def test_runs_like_all_lags():
    rng = random.Random(5)
    rows = [[], [1], fibonacci(700), thue_morse(800), [0] * 500, [0, 1] * 300, list(range(400)), list(range(150)) * 4 + [7] * 40]
    rows += [broken(rng, 600, p, kinds, b) for p in (1, 5, 31, 32, 33, 64, 100, 199, 300) for kinds in (2, 50) for b in (0, 1, 3)]
    rows += [nested(rng, 900) for _ in range(25)]
    assert fast(rows) == [brute(r) for r in rows]
    assert fast([]) == []


def test_halves_that_lie_in_two_short_runs():
    """Every window of the first half lies in one run of period 2, so only the step between two such runs gives the period."""
    row = [0, 1] * 60 + [0] + [0, 1] * 60 + [0]
    assert (0, len(row), 121) in brute(row)
    assert fast([row]) == [brute(row)]


def test_wrong_fingerprints_are_scanned(monkeypatch):
    """Fingerprints of nearly no bits: everything seems equal, and only the words decide."""
    rng = random.Random(2)
    rows = [broken(rng, 300, p, 30, 1) for p in (40, 70, 120)] + [nested(rng, 400) for _ in range(6)]
    monkeypatch.setattr(periodic_runs, "SIDES", ((3, 2), (5, 3)))
    found = fast(rows)
    for row, runs in zip(rows, found, strict=True):
        want = brute(row)
        assert set(runs) <= set(want) and all(row[s : e - q] == row[s + q : e] for s, e, q in runs)


def test_minimizers_stay_few_in_repetitive_text():
    x = np.array(fibonacci(20000), np.int64)
    prefixes = periodic_runs.Prefixes(x)
    for scale in (32, 256, 2048):
        hashes = prefixes.grams(scale // 2, len(x))
        dull = np.zeros(len(hashes), bool)
        for q in range(1, scale // 4 + 1):
            for s, e in zip(*periodic_runs.lag_runs(x, q, scale // 2), strict=True):
                dull[s : e - scale // 2 + 1] = True
        at, lags = periodic_runs.minimizer_pairs(hashes, dull, scale)
        assert len(at) <= 8 * len(x) / (scale / 4) and ((lags >= scale) & (lags < 2 * scale)).all()


def plain_digests(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = [(s, e - s, q) for s, e, q in brute(words)]
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    shown = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return doc_id, len(runs), *shown, sha(listed.encode()), sha(kept)


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_like_plain_version(spark, folder):
    rows = [r for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if len((r.text or "").split()) < 3000]
    got = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, folder).collect()}
    frame = queries.op11_periodic_runs(spark, folder)
    assert frame.columns == COLUMNS and any(zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in rows)
    for r in rows:
        assert got[r.doc_id] == plain_digests(r.doc_id, r.text)


@pytest.mark.parametrize("slice_bytes", [64, 4 << 20])
def test_odd_rows(spark, odd, none, slice_bytes, monkeypatch):
    from tonegauge.llm import blocks

    monkeypatch.setattr(blocks, "BLOCK_BYTES", slice_bytes)
    rows = odd.withColumnRenamed("score", "runs").withColumnRenamed("block", "text_")
    found = periodic_runs.find_runs(rows)
    assert found.columns == ["doc_id", "text_", "n_words", "runs", "collapsed"]
    by_block = {r.text_: r for r in found.collect()}
    texts = {r.block: r.text for r in odd.collect()}
    for block, r in by_block.items():
        words = (texts[block] or "").encode().split()
        want = [] if len(words) > 3000 else [(s, e - s, q) for s, e, q in brute(words)]
        if len(words) <= 3000:
            assert [tuple(x) for x in r.runs] == want and r.n_words == len(words)
    assert periodic_runs.find_runs(none).count() == 0
    assert queries.digest_runs(periodic_runs.find_runs(none)).columns == COLUMNS
