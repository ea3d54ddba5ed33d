"""Secrets in texts: a keyword automaton finds where to look, anchored patterns decide, embedded checksums confirm.

1. One Aho-Corasick automaton over all keywords runs once over the lower-cased text.
2. Each kind's pattern is matched only at the places of its own keywords. Runs of hexadecimal digits have no keyword; they
   are found by a scan for long runs.
3. Kinds whose format carries a check (a CRC-32 in base 62, a JSON header in base 64) are reported only if it holds.

Base kinds are ``assign``, ``access`` and ``hex``; the others are in ``MORE``. A span is kind:start:end in code points, end
exclusive, over the whole match. Within a kind matches are leftmost and do not overlap; matches that fail a kind's length are
dropped after matching.

Defined results: a null text has no spans, is redacted to null, and counts as empty; rows are independent, so copies, ties and
empty tables need no care; input columns are kept, result columns replace those of the same name. Memory is one text.
"""

import base64
import json
import re
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonegauge.llm import blocks

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62(number: int, width: int) -> str:
    out = ""
    for _ in range(width):
        number, digit = divmod(number, 62)
        out = BASE62[digit] + out
    return out


def crc_tail(match: re.Match) -> bool:
    """The last six characters are the CRC-32 of the random part in base 62."""
    body, tail = match[1][:-6], match[1][-6:]
    return base62(zlib.crc32(body.encode()), 6) == tail


def json_head(match: re.Match) -> bool:
    """The first part of a signed token is a JSON object that names its algorithm."""
    head = match[0].split(".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, TypeError):
        return False


def always(match: re.Match) -> bool:
    return True


#: kind: keywords in lower case, pattern, check. The order is the order of kinds at one place.
KINDS: dict[str, tuple[list[str], re.Pattern, Callable[[re.Match], bool]]] = {
    "assign": (
        ["password", "passwd", "secret", "token", "apikey", "api_key"],
        re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I),
        lambda m: len(m[2]) >= 6,
    ),
    "access": (["akia"], re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
}
HEX = re.compile(r"[0-9a-f]{24,}")
MORE: dict[str, tuple[list[str], re.Pattern, Callable[[re.Match], bool]]] = {
    "github": (["ghp_", "gho_", "ghu_", "ghs_", "ghr_"], re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), crc_tail),
    "npm": (["npm_"], re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), crc_tail),
    "jwt": (["eyj"], re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), json_head),
    "slack": (["xoxb-", "xoxp-", "xoxa-"], re.compile(r"xox[bpa]-[0-9]{8,}-[A-Za-z0-9-]{10,}"), always),
    "google": (["aiza"], re.compile(r"AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])"), always),
    "stripe": (["sk_live_", "rk_live_"], re.compile(r"[sr]k_live_[A-Za-z0-9]{16,}"), always),
    "pem": (["-----begin"], re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----"), always),
}
BASE = ["assign", "access", "hex"]
ORDER = {kind: k for k, kind in enumerate([*BASE, *MORE])}


class Scanner:
    def __init__(self):
        self.words = ahocorasick.Automaton()
        self.kinds = KINDS | MORE
        by_word: dict[str, list[str]] = {}
        for kind, (words, _, _) in self.kinds.items():
            for word in words:
                by_word.setdefault(word, []).append(kind)
        for word, kinds in by_word.items():
            self.words.add_word(word, (len(word), kinds))
        self.words.make_automaton()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """All spans by start, then kind."""
        found = [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
        # only A-Z change, so places stay the same
        lowered = text.encode().lower().decode()
        at: dict[str, list[int]] = {}
        for end, (length, kinds) in self.words.iter(lowered):
            for kind in kinds:
                at.setdefault(kind, []).append(end - length + 1)
        for kind, starts in at.items():
            _, pattern, good = self.kinds[kind]
            free = 0
            for start in sorted(starts):
                if start >= free and (m := pattern.match(text, start)):
                    free = m.end()
                    if good(m):
                        found.append((kind, start, free))
        return sorted(found, key=lambda x: (x[1], ORDER[x[0]], x[2]))


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """The text with every stretch that spans cover replaced by one mark."""
    out, done = [], 0
    k = 0
    while k < len(spans):
        start, end = spans[k][1], spans[k][2]
        while k + 1 < len(spans) and spans[k + 1][1] < end:
            k += 1
            end = max(end, spans[k][2])
        out += [text[done:start], mark]
        done = end
        k += 1
    return "".join([*out, text[done:]])


SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"


def scan(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", redact: bool = True) -> DataFrame:
    """``docs`` without ``text`` and with ``spans`` and, if asked for, ``redacted``."""
    added = {"spans", "redacted"}
    others = [c for c in docs.columns if c not in {text, *added}]
    body = blocks.unused(docs.columns)
    rows = docs.select(*others, F.col(text).cast("string").alias(body))
    fields = [rows.schema[c] for c in others] + T.StructType.fromDDL(f"spans {SPANS}" + ", redacted string" * redact).fields

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in (part for b in batches for part in blocks.slices(b, blocks.byte_lengths(b.column(body)))):
            spans, clean = [], []
            for value in batch.column(body):
                content = value.as_py()
                found = scanner.spans(content) if content else []
                spans.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in found])
                if redact:
                    clean.append(redacted(content, found, mark) if found else content)
            columns = [pa.array(spans, kind), *([pa.array(clean, pa.string())] if redact else [])]
            yield pa.RecordBatch.from_arrays([*batch.select(others).columns, *columns], [f.name for f in fields])

    return rows.mapInArrow(find, T.StructType(fields))
