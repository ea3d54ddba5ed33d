"""Subword encoding and decoding with a SentencePiece vocabulary, by shared-prefix Viterbi.

A text gets a leading mark and a mark for each space, and falls into marked words (marks, then characters without marks). No
piece of the vocabulary has a mark behind another character, so words can be encoded apart. The distinct words of a slice of
rows that the worker does not remember are sorted; going through them in that order is a depth-first walk of their trie: the forward scores of the common prefix
with the word before stay, and only the rest is worked out. A word's ids are then looked up for each occurrence.

The segmentation has the highest sum of piece scores; ties go to the longer last piece. Characters that no piece covers cost
more than any piece and become the ids of their UTF-8 bytes.

Defined results: null and empty texts have no ids and decode to the empty text; rows are independent; input columns are kept,
result columns replace those of the same name. Decoding gives the text back exactly, unless the text itself has the mark
character, which decodes to a space, as in the library. A slice is 4 MB of texts or one row, whatever its length; a worker holds one
vocabulary and a bounded number of bytes of remembered words.
"""

import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonegauge.llm import blocks

MARK = "▁"
SLICE_BYTES = 4 << 20
#: Bytes of words and of their ids that a worker remembers before it starts afresh.
REMEMBERED_BYTES = 16 << 20
#: Tells a string that ends no piece from one that is itself no piece.
NONE = object()
WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall


class Vocabulary:
    def __init__(self, model: str, encodes: bool = True):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: list[int] = [0] * 256
        self.spelled: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.spelled.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.spelled.append(b"")
            else:
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {i} has a mark inside: words can't be encoded apart")
                self.ids[piece] = i
                self.scores[piece] = model.get_score(i)
                self.spelled.append(piece.replace(MARK, " ").encode())
        self.known: dict[str, bytes] = {}
        self.held = 0
        if not encodes:
            return
        # every end of a piece; with its score where it is a piece itself
        self.tails: dict[str, float | None] = {p[k:]: None for p in self.ids for k in range(len(p))} | self.scores
        self.unknown = min(self.scores.values()) - 10

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        if MARK + MARK in marked or marked.endswith(MARK):
            return WORDS(marked)
        return [MARK + w for w in marked.split(MARK)[1:]]

    def encode(self, words: list[str]) -> dict[str, bytes]:
        """Ids, as 32-bit bytes, of distinct words."""
        codes = {}
        scores, tail = self.scores, self.tails.get
        before, best, back = "", [0.0], [0]
        for word in sorted(words):
            shared = 0
            for x, y in zip(before, word, strict=False):
                if x != y:
                    break
                shared += 1
            del best[shared + 1 :], back[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                top, start = None, 0
                for begin in range(end - 1, -1, -1):
                    score = tail(word[begin:end], NONE)
                    if score is NONE:
                        break
                    if score is not None:
                        score += best[begin]
                        if top is None or score >= top:
                            top, start = score, begin
                if word[end - 1] not in scores and (top is None or best[end - 1] + self.unknown > top):
                    top, start = best[end - 1] + self.unknown, end - 1
                best.append(top)
                back.append(start)
            codes[word] = self.path(word, back)
            before = word
        return codes

    def codes(self, words: list[list[str]]) -> dict[str, bytes]:
        """Ids of all words of some texts; those worked out before are remembered."""
        if self.held > REMEMBERED_BYTES:
            self.known, self.held = {}, 0
        new = self.encode([w for w in set().union(*words) if w not in self.known])
        self.held += sum(map(len, new)) + sum(map(len, new.values()))
        self.known |= new
        return self.known

    def path(self, word: str, back: list[int]) -> bytes:
        ids, end = [], len(word)
        while end:
            piece = word[back[end] : end]
            found = self.ids.get(piece)
            ids += [found] if found is not None else [self.bytes[b] for b in reversed(piece.encode())]
            end = back[end]
        return array("I", reversed(ids)).tobytes()

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.spelled.__getitem__, memoryview(ids).cast("I"))).decode(errors="replace")[1:]


def encode(docs: DataFrame, model: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` and ``ids`` (binary, little-endian 32-bit), ``n_pieces`` and ``n_words``; if ``decoded``, also the text that the ids
    decode to, worked out in the same pass."""
    added = "ids binary, n_pieces bigint, n_words bigint" + (", decoded string" if decoded else "")
    added = T.StructType.fromDDL(added)
    others = [c for c in docs.columns if c not in added.names]
    body = blocks.unused(docs.columns)
    rows = docs.select(*others, F.col(text).cast("string").alias(body))
    schema = T.StructType([*[rows.schema[c] for c in others], *added.fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model)
        for batch in batches:
            for part in blocks.slices(batch, blocks.byte_lengths(batch.column(body)), SLICE_BYTES):
                words = [vocabulary.words(x.as_py() or "") for x in part.column(body)]
                codes = vocabulary.codes(words)
                ids = [b"".join(map(codes.__getitem__, w)) for w in words]
                columns = [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([len(w) for w in words], pa.int64())]
                if decoded:
                    columns.append(pa.array(map(vocabulary.decode, ids), pa.string()))
                yield pa.RecordBatch.from_arrays([*part.select(others).columns, *columns], schema.names)

    return rows.mapInArrow(work, schema)


def decode(rows: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``rows`` and ``decoded``; null ids are null."""
    others = [c for c in rows.columns if c != "decoded"]
    schema = T.StructType([*[rows.schema[c] for c in others], T.StructField("decoded", T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model, encodes=False)
        for batch in batches:
            for part in blocks.slices(batch, blocks.byte_lengths(batch.column(ids)), SLICE_BYTES):
                texts = [None if x is None else vocabulary.decode(x) for x in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.select(others).columns, pa.array(texts, pa.string())], schema.names)

    return rows.select(*others).mapInArrow(work, schema)
