"""Periodic runs of words: maximal stretches that repeat with their smallest period, found by multi-scale minimizers.

A run is a stretch of words with smallest period q (words q apart are equal), at least ``shortest`` words and two periods
long, that no neighbouring word extends.

1. Short periods (below ``SCANNED``) are found by direct lag scans: words are compared with those q places on.
2. Every further scale takes the periods from L to 2 L - 1. A window of L words has L // 2 + 1 grams of L // 2 words; its
   minimizers are the grams of smallest hash. Inside a run of period q >= L the first window of a run and the window q words
   on are equal, so equal minimizers lie exactly q apart. Pairs of equal minimizers less than 2 L apart are the seeds.
   Grams that have a period of a quarter of L or less are never minimizers: equal grams then lie more than L // 4 apart, and
   a minimizer has at most eight partners, whatever the text.
3. Where a window has only such grams it lies in one run of a short period, which a smaller scale has found. A longer run whose
   halves are both like this crosses two neighbouring short runs of one period, and the shift between the two gives its
   periods. These seeds are added, so no run is lost.
4. Seeds are extended to both sides by halving steps over prefix fingerprints; the runs are then compared word by word, and a
   lag whose fingerprints were wrong is scanned directly.

A stretch found at several lags is one run with the smallest of them. Rows are independent; a slice of rows is worked on as
one sequence with a separator of its own after each row, longest rows first, so a scale reads only the rows that can hold it.

Defined results: null and empty texts have no word and no run; text is bytes, words are separated by space and the bytes 9 to
13; input columns are kept but for the text, result columns replace those of the same name; rows that repeat, with or without
an id, are worked on apart; an empty table gives an empty result. Memory is a slice of ``blocks.BLOCK_BYTES`` or one row.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonegauge.llm import blocks

SHORTEST = 12
#: Periods below this are found by lag scans. Grams of the first scale are SCANNED // 2 words, no shorter than a shortest run.
SCANNED = 32
#: Primes below 2^31 and bases of the two prefix fingerprints.
SIDES = ((2147483647, 1103515245), (2147483629, 630360016))


def lag_runs(x: np.ndarray, lag: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches with period ``lag``, at least two periods and ``shortest`` long."""
    if len(x) <= lag:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.zeros(len(x) - lag + 2, bool)
    np.equal(x[:-lag], x[lag:], out=same[1:-1])
    change = np.flatnonzero(same[1:] != same[:-1])
    starts, ends = change[::2], change[1::2] + lag
    enough = ends - starts >= max(shortest, 2 * lag)
    return starts[enough], ends[enough]


class Prefixes:
    """Fingerprints of all stretches of a sequence of word numbers."""

    def __init__(self, x: np.ndarray):
        self.n = len(x)
        self.sides = []
        for prime, base in SIDES:
            p = np.uint64(prime)
            powers = np.ones(self.n + 1, np.uint64)
            done, step = 1, base % prime
            while done <= self.n:  # powers[done + k] = powers[k] * base ** done
                more = min(done, self.n + 1 - done)
                powers[done : done + more] = powers[:more] * np.uint64(step) % p
                done, step = done + more, step * step % prime
            values = (x.astype(np.uint64) * np.uint64(2654435761) + np.uint64(97)) % p
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(values * powers[: self.n] % p, out=sums[1:])
            self.sides.append((p, powers, sums % p))

    def grams(self, length: int, n: int) -> np.ndarray:
        """Mixed fingerprints of the stretches of ``length`` that start in the first ``n - length + 1`` places."""
        count = n - length + 1
        mixed = np.zeros(count, np.uint64)
        for p, powers, sums in self.sides:
            part = (sums[length : n + 1] + p - sums[:count]) % p * powers[n - length :: -1][:count] % p
            mixed = (mixed << np.uint64(31)) | part
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
        return mixed

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether stretches at ``a`` and ``b`` (a < b) agree; all lie inside the sequence."""
        same = np.ones(len(a), bool)
        for p, powers, sums in self.sides:
            one = (sums[a + length] + p - sums[a]) % p * powers[b - a] % p
            same &= one == (sums[b + length] + p - sums[b]) % p
        return same

    def extended(self, at: np.ndarray, lag: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The furthest start and end of the stretch of period ``lag`` around ``at``, between ``first`` and ``last``."""
        right, room = np.zeros(len(at), np.int64), last - at - lag
        left, back = np.zeros(len(at), np.int64), at - first
        step = 1 << int(max(room.max(initial=0), back.max(initial=0), 1)).bit_length()
        while step := step >> 1:
            try_ = np.flatnonzero(right + step <= room)
            a = at[try_] + right[try_]
            ok = self.equal(a, a + lag[try_], np.full(len(try_), step))
            right[try_[ok]] += step
            try_ = np.flatnonzero(left + step <= back)
            a = at[try_] - left[try_] - step
            ok = self.equal(a, a + lag[try_], np.full(len(try_), step))
            left[try_[ok]] += step
        return at - left, at + right + lag


def sliding(values: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """``pick`` (minimum or maximum) over every window of ``width``, by prefixes and suffixes of blocks of that width."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, fill, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(-1, width)
    ahead = pick.accumulate(grid, axis=1).ravel()
    behind = pick.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[:count], ahead[width - 1 : width - 1 + count])


def minimizer_pairs(hashes: np.ndarray, dull: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal minimizers and their distance, from ``scale`` to less than twice that."""
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    hashes = np.where(dull, top, hashes)
    width = scale // 2 + 1
    if len(hashes) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = sliding(hashes, width, np.minimum, 0xFFFFFFFFFFFFFFFF)
    # a gram is a minimizer if it is the least of any window that holds it
    around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    chosen = np.flatnonzero((sliding(around, width, np.maximum, 0) == hashes) & ~dull)
    order = np.argsort(hashes[chosen], kind="stable")
    places, names = chosen[order], hashes[chosen][order]
    found_at, found_lag = [], []
    ahead, alive = 1, np.arange(max(len(places) - 1, 0))
    while len(alive):
        other = alive + ahead
        near = (names[other] == names[alive]) & (places[other] - places[alive] < 2 * scale)
        alive, other = alive[near], other[near]
        lags = places[other] - places[alive]
        far = lags >= scale
        found_at.append(places[alive][far])
        found_lag.append(lags[far])
        ahead += 1
        alive = alive[alive + ahead < len(places)]
    if not found_at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_at), np.concatenate(found_lag)


def crossing_seeds(x: np.ndarray, runs: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(place, lag) for the longer runs whose halves lie in two neighbouring runs of one period."""
    seeds = []
    ordered = sorted(runs, key=lambda r: (r[2], r[0]))
    for (s1, e1, d), (s2, e2, d2) in zip(ordered, ordered[1:], strict=False):
        if d != d2 or d < 2 or s2 > e1:
            continue
        one, two = x[s1 : s1 + d].tobytes() * 2, x[s2 : s2 + d].tobytes()
        turn = one.find(two)
        while turn >= 0 and turn % x.itemsize:
            turn = one.find(two, turn + 1)
        if turn < 0:
            continue
        first = (s2 - s1 - turn // x.itemsize) % d
        most = min(e1 - s1, e2 - s2, (e2 - s1) // 2)
        for lag in range(first if first >= 2 * d else first + -(-(2 * d - first) // d) * d, most + 1, d):
            place = max(s1, s2 - lag)
            if min(e1, e2 - lag) - place >= lag:
                seeds.append((place, lag))
    return seeds


def runs_of(x: np.ndarray, edges: np.ndarray, shortest: int = SHORTEST) -> np.ndarray:
    """Rows (start, end, period) of all runs of several sequences that lie end to end in ``x``, the longest first, each with a
    number of its own at its end. ``edges``: where each begins, and the end of the last."""
    lengths = np.diff(edges)
    best: dict[tuple[int, int], int] = {}
    fresh: list[tuple[int, int, int]] = []

    def take(starts: np.ndarray, ends: np.ndarray, lags: np.ndarray) -> None:
        for run in sorted(zip(lags.tolist(), starts.tolist(), ends.tolist(), strict=True)):
            lag, start, end = run
            if (start, end) not in best:
                best[start, end] = lag
                fresh.append((start, end, lag))

    # the first scale needs every run of a quarter of its size, which is no shorter than its grams
    assert SCANNED // 2 >= shortest or not len(x)
    for lag in range(1, SCANNED):
        long = int(np.searchsorted(-lengths, -max(shortest, 2 * lag), "right"))
        starts, ends = lag_runs(x[: edges[long]], lag, shortest)
        take(starts, ends, np.full(len(starts), lag))
    scale = SCANNED
    prefixes = None
    held: list[tuple[int, int]] = []
    while (long := int(np.searchsorted(-lengths, -2 * scale, "right"))) > 0:
        n = int(edges[long])
        here = x[:n]
        if prefixes is None:
            prefixes = Prefixes(here)
        held += crossing_seeds(here, fresh)
        fresh = []
        gram = scale // 2
        hashes = prefixes.grams(gram, n)
        # grams inside a run of a short period
        change = np.zeros(n + 2, np.int32)
        for (start, end), lag in best.items():
            if 2 * lag <= gram and end <= n and end - start >= gram:
                change[start] += 1
                change[end - gram + 1] -= 1
        dull = np.cumsum(change[: len(hashes)]) > 0
        at, lag = minimizer_pairs(hashes, dull, scale)
        now = [(p, q) for p, q in held if scale <= q < 2 * scale]
        held = [(p, q) for p, q in held if q >= 2 * scale]
        if now:
            at = np.concatenate([at, [p for p, _ in now]])
            lag = np.concatenate([lag, [q for _, q in now]])
        if len(at):
            row = np.searchsorted(edges, at, "right") - 1
            starts, ends = prefixes.extended(at, lag, edges[row], np.minimum(edges[row + 1], n))
            enough = ends - starts >= np.maximum(shortest, 2 * lag)
            found = np.unique(np.stack([lag, starts, ends], axis=1)[enough], axis=0)
            wrong = set()
            good = []
            for q, s, e in found.tolist():
                if np.array_equal(x[s : e - q], x[s + q : e]):
                    good.append((q, s, e))
                else:  # two stretches with one fingerprint: this lag is scanned instead
                    wrong.add(q)
            for q in wrong:
                good += [(q, s, e) for s, e in zip(*(z.tolist() for z in lag_runs(here, q, shortest)), strict=True)]
            if good:
                q, s, e = np.array(good).T
                take(s, e, q)
        scale *= 2
    if not best:
        return np.zeros((0, 3), np.int64)
    return np.array(sorted((s, e, q) for (s, e), q in best.items()), np.int64)


def word_numbers(rows: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of words end to end as numbers, the longest first, each closed by a number of its own; their edges and order."""
    order = np.array(sorted(range(len(rows)), key=lambda k: -len(rows[k])), np.int64)
    known: dict[bytes, int] = {}
    number = known.setdefault
    out = []
    for place, k in enumerate(order.tolist()):
        out.extend([number(w, len(known)) for w in rows[k]])
        out.append(-1 - place)
    edges = np.concatenate([[0], np.cumsum([len(rows[k]) + 1 for k in order.tolist()])]).astype(np.int64)
    return np.array(out, np.int64), edges, order


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words a run holds behind its first period."""
    change = np.zeros(n + 1, np.int32)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


def find_runs(docs: DataFrame, text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """``docs`` without ``text``, and ``n_words``, ``runs`` (array of start, length, period in words, by start, then period) and
    ``collapsed`` (binary: the words that no run repeats, joined by one space)."""
    added = ["n_words", "runs", "collapsed"]
    others = [c for c in docs.columns if c not in {text, *added}]
    body = blocks.unused(docs.columns)
    rows = docs.select(*others, F.col(text).cast("binary").alias(body))
    schema = T.StructType([
        *[rows.schema[c] for c in others],
        *T.StructType.fromDDL("n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary").fields,
    ])
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks.slices(batch, blocks.byte_lengths(batch.column(body))):
                words = [(x.as_py() or b"").split() for x in part.column(body)]
                numbers, edges, order = word_numbers(words)
                found = runs_of(numbers, edges, shortest)
                row = np.searchsorted(edges, found[:, 0], "right") - 1
                of_row: dict[int, list[tuple[int, int, int]]] = {}
                for k, (start, end, period) in zip(row.tolist(), found.tolist(), strict=True):
                    of_row.setdefault(int(order[k]), []).append((start - int(edges[k]), end - start, period))
                kept = []
                for k, own in enumerate(words):
                    if k in of_row:
                        of_row[k].sort(key=lambda r: (r[0], r[2]))
                        gone = dropped(len(own), of_row[k]).tolist()
                        own = [w for w, out in zip(own, gone, strict=True) if not out]
                    kept.append(b" ".join(own))
                runs = [[{"start": s, "length": n, "period": q} for s, n, q in of_row.get(k, [])] for k in range(len(words))]
                columns = [pa.array([len(w) for w in words], pa.int64()), pa.array(runs, run_type), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays([*part.select(others).columns, *columns], schema.names)

    return rows.mapInArrow(work, schema)
