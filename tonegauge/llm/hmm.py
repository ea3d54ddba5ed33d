"""Language-model scores from a hidden Markov model trained by Baum-Welch.

Tokens are lower-cased (A-Z) words and one end per text. Counts of all tokens of the training rows give the base model: a
token with count c has probability (c + 0.1) / (N + 0.1 (V + 1)), and all unknown tokens share one such place with c = 0.

The hidden Markov model has ``states`` latent states, and every training token has its own emission in each of them: the base
model's probability times a ratio (1 for unknown tokens). Each text's state in front of its first token follows a trained start
distribution. The score is exact: the forward recursion runs over whole texts, in pieces of fixed length whose transfer
matrices are multiplied, rescaled as it goes.

Training: a block is some texts with one vocabulary, worked on in parts. Blocks send the keys of their tokens once, to the
buckets of the keys, and learn the place of each token in its bucket. In each round every block runs forward and backward over
its training texts and sends, by place, its tokens' counts and how they divide over the states; a bucket adds up and answers
every block with the same for the corpus. The emissions are thus a table keyed by token that no task and not the driver holds
whole; the driver sees only sums over states. Divisions move in steps of 1/255 (states - 1 bytes a token), and the sums over
states are those of the moved numbers, so each state's emissions add up to one. Blocks are written by a hash of their number and
never move; a round's answers are discarded when the next ones are written.

Defined results: null and empty texts are the end alone; rows are independent; copies count as often as they occur; with no
training row every token is unknown and the model's ratio is 1; an empty table gives no row; input columns (without the text)
are kept, result columns replace those of the same name.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonegauge.llm import blocks
from tonegauge.llm.store import bucketed, discard, written

STATES = 6
ROUNDS = 4
#: Text of a block, which has one vocabulary, and of a part, which is worked on at once.
BLOCK_BYTES = 12 << 20
PART_BYTES = 1 << 20
#: Steps in which a token's division over the states moves.
STEPS = 255
#: Tokens of a piece; pieces run side by side.
PIECE = 128
#: How far the first emissions of the states lie apart.
LEAN = 0.5
#: Weight of the base model in a state's emissions.
PRIOR = 20.0
TOKENS = (
    "block bigint, rows array<binary>, sizes array<binary>, ids array<binary>, keys binary, learns array<binary>, train binary"
)


class Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Block:
    """Texts that share a vocabulary, as parts of numbered tokens."""

    def __init__(self):
        self.vocabulary = Numbers()
        self.vocabulary[b""]  # no word is empty: this is the end
        self.bytes, self.rows, self.sizes, self.ids, self.learns = 0, [], [], [], []

    def add(self, part: pa.RecordBatch, text: str, learns: str) -> None:
        ids, sizes = [], []
        number = self.vocabulary.__getitem__
        for value in part.column(text):
            words = (value.as_py() or b"").lower().split()
            words.append(b"")
            ids.append(np.fromiter(map(number, words), np.uint32, len(words)))
            sizes.append(len(words))
        self.bytes += int(blocks.byte_lengths(part.column(text)).sum())
        self.rows.append(blocks.to_stream(part.select([c for c in part.schema.names if c != text])))
        self.sizes.append(np.array(sizes, np.int64))
        self.ids.append(np.concatenate(ids))
        self.learns.append(pa.compute.fill_null(part.column(learns), False).to_numpy(zero_copy_only=False).astype(bool))

    def row(self, block: int) -> pa.RecordBatch:
        """The block with its vocabulary in the order of the tokens' keys."""
        keys = np.array([xxhash.xxh64_intdigest(w) for w in self.vocabulary], np.uint64)
        order = np.argsort(keys)
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        train = np.zeros(len(keys), np.int64)
        ids = [place[x] for x in self.ids]
        for own, sizes, learns in zip(ids, self.sizes, self.learns, strict=True):
            train += np.bincount(own[np.repeat(learns, sizes)], minlength=len(keys))
        listed = pa.list_(pa.binary())
        return pa.RecordBatch.from_pydict(
            {
                "block": [block],
                "rows": pa.array([self.rows], listed),
                "sizes": pa.array([[x.tobytes() for x in self.sizes]], listed),
                "ids": pa.array([[split_planes(x) for x in ids]], listed),
                "keys": [blocks.encode(keys[order])],
                "learns": pa.array([[x.tobytes() for x in self.learns]], listed),
                "train": [split_planes(train.astype(np.uint32))],
            }
        )


def tokenized(docs: DataFrame, text: str, learns: str) -> DataFrame:
    """Blocks of texts as numbers into the block's own sorted vocabulary of 64-bit token keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = blocks.numbers(), Block()
        for batch in batches:
            for part in blocks.slices(batch, blocks.byte_lengths(batch.column(text)), PART_BYTES):
                block.add(part, text, learns)
                if block.bytes >= BLOCK_BYTES:
                    yield block.row(next(number))
                    block = Block()
        if block.rows:
            yield block.row(next(number))

    return bucketed(docs.mapInArrow(work, TOKENS), "block")


def split_planes(values: np.ndarray) -> bytes:
    """32-bit numbers, byte planes apart."""
    return blocks.squeeze(np.ascontiguousarray(values.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes())


def ids_of(data: bytes) -> np.ndarray:
    planes = np.frombuffer(blocks.unsqueeze(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel()


def steps_of(expected: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How tokens divide over the states, in steps (tokens by states but the last, which has the rest)."""
    shares = np.rint(expected[:, :-1] * (STEPS / np.maximum(counts, 1e-300))[:, None]).astype(np.int32)
    over = np.maximum(shares.sum(axis=1) - STEPS, 0)
    if shares.shape[1]:
        shares[np.arange(len(shares)), shares.argmax(axis=1)] -= over
    return shares.astype(np.uint8)


def shares_of(steps: np.ndarray) -> np.ndarray:
    rest = STEPS - steps.sum(axis=1, dtype=np.int64)
    return np.concatenate([steps, rest[:, None]], axis=1) / STEPS


def packed(steps: np.ndarray) -> bytes:
    return blocks.squeeze(np.ascontiguousarray(steps.T).tobytes())


def unpacked(data: bytes, states: int) -> np.ndarray:
    if states == 1:  # nothing is sent for the only state but the number of tokens
        return np.zeros((len(blocks.unsqueeze(data)), 0), np.uint8)
    return np.frombuffer(blocks.unsqueeze(data), np.uint8).reshape(states - 1, -1).T


def lean(keys: np.ndarray, states: int) -> np.ndarray:
    """How the states first lean to each token (tokens by states): log-normal, from the token's key alone."""
    with np.errstate(over="ignore"):
        x = keys[:, None] + np.arange(1, 2 * states + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    uniform = (((x ^ (x >> np.uint64(31))) >> np.uint64(11)) + 0.5) / (1 << 53)
    return np.exp(LEAN * np.sqrt(-2 * np.log(uniform[:, :states])) * np.cos(2 * np.pi * uniform[:, states:]))


#: Rows of block -1 hold a bucket's own sums.
ANSWERED = f"{blocks.REPLY}, places binary, sums array<double>"


def answered(table: pa.Table, replies: list[bytes], sums: np.ndarray, places: list[bytes] | None = None) -> pa.Table:
    asking = [b for b in table.column("block").to_pylist() if b >= 0]
    return pa.table(
        {
            "block": pa.array([*asking, -1], pa.int64()),
            "bucket": pa.array([table.column("bucket")[0].as_py()] * (len(asking) + 1), pa.int32()),
            "reply": pa.array([*replies, None], pa.binary()),
            "places": pa.array([*(places or [None] * len(asking)), None], pa.binary()),
            "sums": pa.array([*[None] * len(asking), sums.tolist()], pa.list_(pa.float64())),
        }
    )


def count_bucket(table: pa.Table, states: int) -> pa.Table:
    """For each asking block the corpus counts of its tokens, and their places in the bucket; sums: all tokens, distinct
    tokens, weights by state."""
    held = [blocks.decode(x) for x in table.column("keys").to_pylist()]
    distinct, back = np.unique(np.concatenate(held), return_inverse=True)
    places = np.split(back, np.cumsum([len(x) for x in held])[:-1])
    counts = np.zeros(len(distinct), np.int64)
    for at, x in zip(places, table.column("extra").to_pylist(), strict=True):
        counts[at] += ids_of(x)
    known = counts > 0
    weights = (counts[known] + 0.1) @ lean(distinct[known], states)
    sums = np.concatenate([[counts.sum(), known.sum()], weights])
    replies = [blocks.squeeze(counts[at].tobytes()) for at in places]
    return answered(table, replies, sums, [blocks.encode(at.astype(np.uint64)) for at in places])


def add_bucket(table: pa.Table, states: int) -> pa.Table:
    """For each asking block how its tokens divide over the states in the whole corpus; sums: expected counts by state, then
    what the tasks' own rows hold. A block's row has the places, and the counts in front of the divisions."""
    own = [b < 0 for b in table.column("block").to_pylist()]
    extra = table.column("extra").to_pylist()
    held = [blocks.decode(x).astype(np.int64) for x, o in zip(table.column("keys").to_pylist(), own, strict=True) if not o]
    size = max((int(x[-1]) + 1 for x in held), default=0)
    expected, counts = np.zeros((size, states)), np.zeros(size)
    for at, x in zip(held, [x for x, o in zip(extra, own, strict=True) if not o], strict=True):
        cut = int.from_bytes(x[:8], "little")
        count = ids_of(x[8 : 8 + cut]).astype(np.float64)
        counts[at] += count
        expected[at] += count[:, None] * shares_of(unpacked(x[8 + cut :], states))
    moved = np.zeros(states * states + states)
    for x in (x for x, o in zip(extra, own, strict=True) if o):
        moved += np.frombuffer(x, np.float64)
    steps = steps_of(expected, counts)
    by_state = counts @ shares_of(steps) if size else np.zeros(states)
    replies = [packed(steps[at]) if states > 1 else blocks.squeeze(bytes(len(at))) for at in held]
    return answered(table, replies, np.concatenate([by_state, moved]))


def summed(replies: DataFrame, size: int) -> np.ndarray:
    """The buckets' sums added up: so many numbers, whatever the vocabulary."""
    out = np.zeros(size)
    for at, value in replies.filter(F.col("block") < 0).select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col")).collect():
        out[at] = value
    return out


class Model:
    """What all blocks share: numbers of tokens, sums by state, moves and start. Emissions come with the replies."""

    def __init__(self, states: int, sums: np.ndarray):
        self.total, self.distinct, self.weights, self.by_state = int(sums[0]), int(sums[1]), sums[2:], None
        self.move = np.full((states, states), 0.2 / max(states - 1, 1))
        np.fill_diagonal(self.move, 0.8 if states > 1 else 1.0)
        self.begin = np.full(states, 1 / states)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.total + 0.1 * (self.distinct + 1)))

    def ratios(self, counts: np.ndarray, keys: np.ndarray | None, replies: list[bytes] | None) -> np.ndarray:
        """A block's tokens by states: emissions over base probabilities; 1 for unknown tokens, and a last row of 1. Before the
        first round the tokens' keys decide."""
        states = len(self.move)
        ratio = np.ones((len(counts) + 1, states))
        known = counts > 0
        if self.by_state is None:
            ratio[:-1][known] = lean(keys[known], states) * (self.total + 0.1 * self.distinct) / self.weights
            return ratio
        steps = np.concatenate([unpacked(x, states) for x in replies]) if replies else np.zeros((0, states - 1), np.uint8)
        expected = counts[known, None] * shares_of(steps[known])
        share = ((counts[known] + 0.1) / (self.total + 0.1 * self.distinct))[:, None]
        ratio[:-1][known] = (expected + PRIOR * share) / ((self.by_state + PRIOR) * share)
        return ratio

    def learn(self, sums: np.ndarray) -> None:
        states = len(self.move)
        self.by_state, moved, begun = sums[:states], sums[states:-states].reshape(states, states) + 1 / states, sums[-states:] + 1 / states
        self.move, self.begin = moved / moved.sum(axis=1, keepdims=True), begun / begun.sum()


class Pieces:
    """Texts as pieces of at most PIECE tokens, longest first; step t takes the t-th token of every piece that has one.

    Tokens are laid out step by step, and arrays have the states first and the pieces last.
    """

    def __init__(self, sizes: np.ndarray):
        ends = np.cumsum(sizes)
        per_text = -(-sizes // PIECE)
        text = np.repeat(np.arange(len(sizes)), per_text)
        turn = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        first = (ends - sizes)[text] + turn * PIECE
        length = np.minimum(first + PIECE, ends[text]) - first
        order = np.argsort(-length, kind="stable")
        self.text, turn, first, length = text[order], turn[order], first[order], length[order]
        self.active = np.searchsorted(-length, -np.arange(length[0] if len(order) else 0), "left").tolist()
        self.edges = [0, *np.cumsum(self.active).tolist()]
        self.tokens = np.concatenate([first[:a] + t for t, a in enumerate(self.active)]) if self.active else np.zeros(0, np.int64)
        by_turn = np.argsort(turn, kind="stable")
        edges = np.searchsorted(turn[by_turn], np.arange(turn.max() + 2 if len(order) else 1))
        self.turns = [by_turn[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        self.texts, self.pieces, self.opens = len(sizes), len(order), turn == 0

    def steps(self) -> list[tuple[int, int, int]]:
        return [(t, a, self.edges[t]) for t, a in enumerate(self.active)]

    def emissions(self, classes: np.ndarray, ratio: np.ndarray) -> np.ndarray:
        """States by tokens, in the order of the steps."""
        kinds = classes[self.tokens]
        return np.stack([ratio[:, s][kinds] for s in range(ratio.shape[1])])

    def forward(self, emit: np.ndarray, move: np.ndarray, begin: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Natural log of each text's ratio, the state shares in front of each piece, and each piece's transfer matrix
        (to state, from state, piece)."""
        k, n = len(move), self.pieces
        turned = np.ascontiguousarray(move.T)
        transfer = np.empty((k, k, n), emit.dtype)
        now = np.broadcast_to(np.eye(k, dtype=emit.dtype)[:, :, None], (k, k, n))
        logs = np.zeros(n)
        for t, a, at in self.steps():
            if a < now.shape[2]:
                transfer[:, :, a : now.shape[2]] = now[:, :, a:]
                now = now[:, :, :a]
            now = (turned @ np.ascontiguousarray(now).reshape(k, -1)).reshape(k, k, a)
            now *= emit[:, None, at : at + a]
            if t % 2:
                scale = now.sum(axis=(0, 1))
                now /= scale
                logs[:a] += np.log(scale)
        transfer[:, :, : now.shape[2]] = now
        inside, front = np.zeros(self.texts), np.empty((k, n), emit.dtype)
        state = np.repeat((np.full(k, 1 / k) if begin is None else begin)[:, None], self.texts, axis=1)
        for rows in self.turns:
            texts = self.text[rows]
            front[:, rows] = state[:, texts]
            after = (transfer[:, :, rows] * state[None, :, texts]).sum(axis=1)
            total = after.sum(axis=0)
            inside[texts] += np.log(total) + logs[rows]
            state[:, texts] = after / total
        return inside, front, transfer

    def expected(self, classes: np.ndarray, ratio: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Baum-Welch: expected emissions (class by state) and moves."""
        return self.learned(classes, ratio, move)[:2]

    def learned(
        self, classes: np.ndarray, ratio: np.ndarray, move: np.ndarray, begin: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected emissions (class by state), moves, and states in front of the texts."""
        emit = self.emissions(classes, ratio)
        _, front, transfer = self.forward(emit, move, begin)
        k, n = len(move), self.pieces
        turned = np.ascontiguousarray(move.T)
        back = np.empty((k, n), np.float32)
        later = np.ones((k, self.texts))
        for rows in reversed(self.turns):
            texts = self.text[rows]
            back[:, rows] = later[:, texts]
            before = (transfer[:, :, rows] * later[:, None, texts]).sum(axis=0)
            later[:, texts] = before / before.sum(axis=0)
        shares = np.empty((k, len(self.tokens)), np.float32)
        state = front
        for _, a, at in self.steps():
            state = turned @ state[:, :a]
            state *= emit[:, at : at + a]
            state /= state.sum(axis=0)
            shares[:, at : at + a] = state
        moves, begun = np.zeros((k, k)), np.zeros(k)
        for t, a, at in reversed(self.steps()):
            here = shares[:, at : at + a]
            outer = emit[:, at : at + a] * back[:, :a]
            # the state in front of this token; earlier steps still hold their forward shares
            came = shares[:, self.edges[t - 1] : self.edges[t - 1] + a] if t else front[:, :a]
            behind = move @ outer
            moves += (came / (came * behind).sum(axis=0)) @ outer.T
            here *= back[:, :a]
            here /= here.sum(axis=0)
            if t:
                behind /= behind.sum(axis=0)
                back[:, :a] = behind
            else:
                first = (came * behind)[:, self.opens]
                begun = (first / first.sum(axis=0)).sum(axis=1)
        kinds = classes[self.tokens]
        emitted = np.stack([np.bincount(kinds, shares[s], len(ratio)) for s in range(k)], axis=1)
        return emitted[:-1], moves * move, begun


def asks(block: int, known: list, emitted: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A block's row for each bucket that has some of its tokens: places, and counts and divisions."""
    edges = np.cumsum([0, *[len(blocks.decode(x["places"])) for x in known]]).tolist()
    parts = []
    for a, b in zip(edges, edges[1:], strict=False):
        count = split_planes(counts[a:b])
        steps = steps_of(emitted[a:b], counts[a:b])
        parts.append(len(count).to_bytes(8, "little") + count + (packed(steps) if steps.shape[1] else blocks.squeeze(bytes(b - a))))
    return pa.RecordBatch.from_pydict(
        {
            "bucket": pa.array([x["bucket"] for x in known], pa.int32()),
            "block": pa.array([block] * len(known), pa.int64()),
            "keys": pa.array([x["places"] for x in known], pa.binary()),
            "extra": pa.array(parts, pa.binary()),
        }
    )


def counts_of(known: list) -> np.ndarray:
    return np.concatenate([np.frombuffer(blocks.unsqueeze(x["reply"]), np.int64) for x in known])


def part_of(got: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token numbers, sizes and learning flags of a block's part."""
    return ids_of(got["ids"][k]), np.frombuffer(got["sizes"][k], np.int64), np.frombuffer(got["learns"][k], bool)


def rounds(table: DataFrame, known: DataFrame, model: Model, times: int, buckets: int) -> DataFrame | None:
    """Trains on the blocks' training texts: per block the replies that hold its tokens' emissions."""
    spark, states = table.sparkSession, len(model.move)
    replies, last = None, None
    for _ in range(times if model.total else 0):

        def work(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            moved, begun = np.zeros((states, states)), np.zeros(states)
            move, begin = model.move.astype(np.float32), model.begin
            for batch in batches:
                for row in range(batch.num_rows):
                    got = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                    counts = counts_of(got["known"])
                    keys = blocks.decode(got["keys"]) if "keys" in got else None
                    ratio = model.ratios(counts, keys, got.get("replies")).astype(np.float32)
                    emitted = np.zeros((len(counts), states))
                    for k in range(len(got["ids"])):
                        ids, sizes, learns = part_of(got, k)
                        if learns.any():
                            e, m, b = Pieces(sizes[learns]).learned(ids[np.repeat(learns, sizes)], ratio, move, begin)
                            emitted += e
                            moved += m
                            begun += b
                    yield asks(got["block"], got["known"], emitted, ids_of(got["train"]))
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array([TaskContext.get().partitionId() % buckets], pa.int32()),
                    "block": pa.array([-1], pa.int64()),
                    "keys": pa.array([None], pa.binary()),
                    "extra": pa.array([np.concatenate([moved.ravel(), begun]).tobytes()], pa.binary()),
                }
            )

        columns = ["block", "sizes", "ids", "learns", "train", *(["keys"] if replies is None else [])]
        joined = table.select(*columns).join(known.hint("merge"), "block")
        if replies is not None:
            joined = joined.join(replies.hint("merge"), "block")
        asked = joined.mapInArrow(work, blocks.ASKED)
        added, path = written(asked.groupBy("bucket").applyInArrow(lambda t: add_bucket(t, states), ANSWERED))
        if last:
            discard(spark, last)
        replies, last = blocks.per_block(added.filter(F.col("block") >= 0).select("block", "bucket", "reply")), path
        model.learn(summed(added, states * states + 2 * states))
    return replies


def scored(docs: DataFrame, learns: Column, text: str = "text", states: int = STATES, times: int = ROUNDS) -> DataFrame:
    """``docs`` without ``text`` and with n_tokens, n_known, train_tokens, base_score and score (log10). ``learns``: the rows
    to train on."""
    spark = docs.sparkSession
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    others = [c for c in docs.columns if c not in {text, *added}]
    body = blocks.unused(docs.columns)
    flag = body + "_"
    rows = docs.select(*others, F.col(text).cast("binary").alias(body), F.coalesce(learns, F.lit(False)).alias(flag))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = tokenized(rows, body, flag)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                keys = blocks.decode(batch.column("keys")[row].as_py())
                train = ids_of(batch.column("train")[row].as_py())
                yield blocks.questions(
                    batch.column("block")[row].as_py(), keys, lambda a, b, train=train: split_planes(train[a:b]), buckets
                )

    asked = table.select("block", "keys", "train").mapInArrow(ask, blocks.ASKED)
    counted, path = written(asked.groupBy("bucket").applyInArrow(lambda t: count_bucket(t, states), ANSWERED))
    model = Model(states, summed(counted, 2 + states))
    listed = F.sort_array(F.collect_list(F.struct("bucket", "reply", "places")))
    known = bucketed(counted.filter(F.col("block") >= 0).groupBy("block").agg(listed.alias("known")), "block")
    discard(spark, path)
    # training works in single precision, scores are exact in double
    emissions = rounds(table, known, model, times, buckets)
    fields = [rows.schema[c] for c in others]
    schema = T.StructType([*fields, *T.StructType.fromDDL("n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double").fields])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                got = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                counts = counts_of(got["known"])
                ratio = model.ratios(counts, blocks.decode(got["keys"]) if "keys" in got else None, got.get("replies"))
                token_base = model.base(counts)
                for k, own in enumerate(got["rows"]):
                    ids, sizes, _ = part_of(got, k)
                    first = np.cumsum(sizes) - sizes
                    base = np.add.reduceat(token_base[ids], first)
                    seen = np.add.reduceat((counts > 0)[ids].astype(np.int64), first)
                    pieces = Pieces(sizes)
                    gain = pieces.forward(pieces.emissions(ids, ratio), model.move, model.begin)[0] / np.log(10)
                    here = blocks.from_stream(own)
                    yield from pa.table(
                        {
                            **{c: here.column(c) for c in others},
                            "n_tokens": pa.array(sizes),
                            "n_known": pa.array(seen),
                            "train_tokens": pa.array(np.full(len(sizes), model.total, np.int64)),
                            "base_score": pa.array(base),
                            "score": pa.array(base + gain),
                        }
                    ).to_batches()

    joined = table.drop("train", *([] if emissions is None else ["keys"])).join(known.hint("merge"), "block")
    return (joined if emissions is None else joined.join(emissions.hint("merge"), "block")).mapInArrow(score, schema)
