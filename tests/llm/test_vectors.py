"""Near-duplicate vectors against all cosines, and prefix tries against sets of sequences."""

import hashlib
import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tonegauge.llm import pivot_index, prefix_trie, queries, store


def plain_links(rows, threshold=0.95):
    """(n_links, component) for each (id, vector) row, by comparing all."""
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    near = [set() for _ in rows]
    for a, (_, v) in enumerate(rows):
        for b in range(a):
            w = rows[b][1]
            if good[a] and good[b] and len(v) == len(w) and pivot_index.exact_cosine(np.array(v), np.array(w)) >= threshold:
                near[a].add(b)
                near[b].add(a)
    out = []
    for a in range(len(rows)):
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        out.append((len(near[a]), min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)))
    return out


def vectors(rng, groups, width=16):
    out = []
    for size, noise in groups:
        centre = rng.normal(size=width)
        out += [(centre + noise * rng.normal(size=width)).tolist() for _ in range(size)]
    return out


def judged(rows, frame, **settings):
    got = pivot_index.near_duplicates(frame, **settings)
    found = {r.place: r for r in got.collect()}
    assert len(found) == len(rows)
    return got, [found[k] for k in range(len(rows))]


def test_vectors_like_all_pairs(spark):
    rng = np.random.default_rng(4)
    some = vectors(rng, [(60, 0.05), (40, 0.2), *[(3, 0.15)] * 20, *[(1, 0.0)] * 60])
    some += [some[3]] * 30 + [[0.0] * 16, None, [1.0, None] * 8, [math.nan] * 16, [math.inf] * 16, [1.0] * 3, [2.0] * 3, [], [-0.0] * 16]
    some += [(2 * np.array(some[5])).tolist()]
    rows = [(1000 - k if k % 7 else 1000 - k + 1, v) for k, v in enumerate(some)] + [(None, some[5]), (None, some[-1]), (None, None)]
    frame = spark.createDataFrame([(i, v, k) for k, (i, v) in enumerate(rows)], "vec_id bigint, embedding array<double>, place int").withColumn("kept", F.lit("x"))
    want = plain_links(rows)
    for settings in ({}, {"cell": 32}, {"nearest": 6, "shared": 2}):
        got, found = judged(rows, frame, **settings)
        assert got.columns == ["vec_id", "place", "n_links", "component_id", "kept"]
        assert [(r.n_links, r.component_id) for r in found] == want
        assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in found)
    assert pivot_index.near_duplicates(frame.limit(0)).count() == 0


def test_recall_in_a_dense_group(spark):
    """A third of all rows lie in one group; pivots may not crowd there."""
    rng = np.random.default_rng(8)
    some = vectors(rng, [(700, 0.12), *[(5, 0.15)] * 60, *[(1, 0.0)] * 900], 32)
    rows = list(enumerate(some))
    frame = spark.createDataFrame([(i, v, i) for i, v in rows], "vec_id bigint, embedding array<double>, place int")
    x = pivot_index.unit(np.array(some))
    true = int(((x @ x.T >= 0.95).sum() - len(x)))
    _, found = judged(rows, frame, cell=256)
    assert 0.9 * true <= sum(r.n_links for r in found) <= true and true > 100000


def test_threshold_is_decided_by_exact_sums():
    a, b = np.array([1.0, 0.0]), np.array([19.0, math.sqrt(39.0)])
    block = lambda v: {"vector": v[None], "norm": np.sqrt((v[None] ** 2).sum(axis=1)), "signature": np.zeros((1, 1), int), "posted": np.zeros((1, 1), int)}
    linked = len(pivot_index.cell_links(block(a), block(b), False, 0, 1, 0.95)[0])
    assert linked == (pivot_index.exact_cosine(a, b) >= 0.95)


# prefix tries


def plain_trie(seqs):
    """Nodes of {conv: [(role, text), ...]} from all prefixes, subtrees by comparing prefixes."""
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    kids = {p: 0 for p in members}
    leaves, saved = dict(kids), dict(kids)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, cs in members.items():
        words = len(p[-1][1].encode().split()) if p else 0
        for k in range(len(p) + 1):
            leaves[p[:k]] += kids[p] == 0
            saved[p[:k]] += (len(cs) - 1) * words
    out = []
    for p, cs in members.items():
        end = ",".join(str(c) for c in sorted(cs) if len(seqs[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(cs), len(p), parent, len(cs), kids[p], leaves[p], saved[p], hashlib.sha256(end.encode()).hexdigest()))
    return sorted(out, key=str)


def plain_sequences(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            text = text or ""
            key = (turn is not None, turn or 0, role or "", hashlib.sha256(text.encode()).hexdigest())
            convs.setdefault(c, []).append((key, (role or "", text)))
    return {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in convs.items()}


def turn_rows(rng):
    said = ["", "a", "a b", "b\ta c", "é ü", "a,b", "x" * 50]
    rows = []
    for c in range(120):
        common = [("user", "hello there"), ("assistant", "hi")] * (c % 3) + [("user", "tell me")] * (c % 5 == 0)
        own = [(rng.choice(["user", "assistant", None]), rng.choice(said)) for _ in range(rng.choice([0, 0, 1, 2, 3, 9, 16, 17, 40]))]
        rows += [(c - 20, k, r, t) for k, (r, t) in enumerate(common + own)]
    rows += [(500, k, "u", f"long {k % 7}") for k in range(300)] + [(501, k, "u", f"long {k % 7}") for k in range(299)]
    rows += [(600, None, "u", "first"), (600, 1, "u", None), (600, 1, "u", "tie"), (600, 1, "a", "tie"), (600, 1, "u", "tie"), (None, 1, "u", "x")]
    rows += [(700 + k, j, "u", f"same {j}") for k in range(9000, 9050) for j in range(8)]
    return rows


def test_trie_like_all_prefixes(spark):
    rows = turn_rows(random.Random(6))
    frame = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").withColumn("depth", F.lit("odd"))
    want = plain_trie(plain_sequences(rows))
    for width in (1, 3, 8, 16):
        got = prefix_trie.prefix_trie(frame, width)
        assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert prefix_trie.prefix_trie(frame.limit(0)).count() == 0


def test_conversations_without_turns(spark):
    seqs = {3: [], 5: [], 4: [("u", "a b")], 9: [("u", "a b"), ("u", "c")], 2: [("u", "a b"), ("u", "c")]}
    turn = lambda r, t: {"id": hashlib.sha256(f"{r}:{t}".encode()).digest()[:16], "words": len(t.split())}
    frame = spark.createDataFrame(
        [(c, [turn(*x) for x in s]) for c, s in seqs.items()], "conv bigint, turns array<struct<id: binary, words: bigint>>"
    )
    for width in (1, 2, 8):
        assert sorted(map(tuple, prefix_trie.trie(frame, width).collect()), key=str) == plain_trie(seqs)


def test_ends_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_A_PIECE", 7)
    seqs = {c: [("u", "x")] * (c % 2) for c in range(-30, 60)}
    turn = {"id": b"1", "words": 1}
    frame = spark.createDataFrame([(c, [turn] * len(s)) for c, s in seqs.items()], "conv bigint, turns array<struct<id: binary, words: bigint>>")
    assert sorted(map(tuple, prefix_trie.trie(frame).collect()), key=str) == plain_trie(seqs)


def test_rebuilt_conversations(spark):
    rows = [(c, k, "u", f"{c % 3} {k}") for c in [*range(0, 45), 61, -20, -13] for k in range(c % 6)]
    seqs = plain_sequences(rows)
    want = {}
    for c, own in seqs.items():
        base = c - int(math.fmod(c, 20))
        h = zlib.crc32(str(c).encode()) % 4
        want[c] = seqs.get(base, [])[:h] + own[h:]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    built = store.stored(queries.rebuilt(prefix_trie.sequences(frame)))
    assert {r.conv: len(r.turns) for r in built.collect()} == {c: len(s) for c, s in want.items()}
    assert sorted(map(tuple, prefix_trie.trie(built).collect()), key=str) == plain_trie(want)
