import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from tonegauge.llm import packing
from tonegauge.llm.queries import tokenizer

PATH = tokenizer("byte_bpe_50k.json")


def plain_best_fit(histogram, capacity):
    rooms = []
    for s in sorted((s for s, n in histogram.items() for _ in range(n)), reverse=True):
        fit = [k for k, r in enumerate(rooms) if r >= s]
        if fit:
            rooms[min(fit, key=lambda k: rooms[k])] -= s
        else:
            rooms.append(capacity - s)
    return len(rooms)


def optimum(sizes, capacity):
    """Fewest sequences, by trying everything."""
    best = len(sizes)

    def put(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for r in {x: i for i, x in enumerate(rooms) if x >= sizes[k]}.values():
            put(k + 1, [*rooms[:r], rooms[r] - sizes[k], *rooms[r + 1 :]])
        put(k + 1, [*rooms, capacity - sizes[k]])

    put(0, [])
    return best


def test_plans_hold_every_piece_and_are_short():
    rng = random.Random(2)
    for _ in range(150):
        capacity = rng.choice([10, 64, 1024])
        histogram = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 150)))
        runs = packing.plan(histogram, capacity)
        held = Counter()
        for pattern, times in runs:
            assert sum(pattern) <= capacity
            for s in pattern:
                held[s] += times
        assert held == histogram
        used = sum(times for _, times in runs)
        assert packing.lower_bound(histogram, capacity) <= used <= plain_best_fit(histogram, capacity) + 1


def test_reduction_never_costs_a_sequence():
    rng = random.Random(3)
    for _ in range(200):
        sizes = sorted((rng.randint(1, 12) for _ in range(rng.randint(1, 8))), reverse=True)
        left = dict(Counter(sizes))
        fixed = sum(times for _, times in packing.reduce(left, 12))
        rest = [s for s, n in left.items() for _ in range(n)]
        assert fixed + optimum(sorted(rest, reverse=True), 12) == optimum(sizes, 12), sizes


def test_reduction_fixes_most_of_a_realistic_histogram():
    """Lengths as documents have them: short ones, few very short ones, and the first pieces of long ones. Tiny pieces don't end it."""
    rng = random.Random(11)
    lengths = [min(1024, int(rng.lognormvariate(6.3, 0.9)) + 1) for _ in range(4000)] + [rng.randint(1, 1024) for _ in range(3000)]
    for tiny in (0, 50):
        histogram = Counter(lengths) + Counter({1: tiny})
        left = dict(histogram)
        packing.reduce(left, 1024)
        fixed = 1 - sum(left.values()) / sum(histogram.values())
        assert fixed > 0.5, fixed
        used = sum(times for _, times in packing.plan(dict(histogram), 1024))
        assert used <= packing.lower_bound(histogram, 1024) * 1.01


@pytest.mark.parametrize("text", [
    "", " ", "a  b", "a \n b", "x<|endoftext|>y", " lead", "trail ", "don't I'll  'tis", "\t\tx\n\n\ny z", "a b", "a\x85 b", "\x1c a",
    "word, word. the&&& 12 3,4 x²y ½", "naïve ß漢字 \U0001f600 ok", "a  b",
])
def test_ids_are_the_tokenizer_s(text):
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.Encoder(PATH).encode(text), "<u4").tolist() == want


def test_pack(odd, none):
    whole = Tokenizer.from_file(PATH)
    rows = packing.pack(odd, PATH)
    assert set(rows.columns) == {"doc_id", "score", "block", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"}
    got = rows.collect()
    ids = Counter(tuple(whole.encode(r.text or "", add_special_tokens=False).ids) + (2,) for r in odd.collect())
    assert sum(r.length for r in got) == sum(len(x) * n for x, n in ids.items())
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert all(r.length == 1024 for r in got if r.piece)
    assert packing.pack(none, PATH).count() == 0
