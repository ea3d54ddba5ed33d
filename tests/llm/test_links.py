"""SimHash groups, top-k search, archives and the pipeline."""

import hashlib
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tonegauge.llm import packing, periodic_runs, pieces, quality, secret_scan, simhash, store, suffix_dedup, top_k, warc
from tonegauge.llm.queries import tokenizer


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, distance):
    """Smallest member index of each value's component, by comparing all."""
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= distance:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return [root(x) for x in range(len(values))]


def test_fingerprints_and_groups(odd, none):
    rows = simhash.near_duplicates(odd)
    assert rows.columns == ["doc_id", "score", "block", "fingerprint", "component_id"]
    for r in rows.join(odd.select("block", "text"), F.equal_null(rows["block"], odd["block"])).collect():
        assert int(r.fingerprint, 16) == plain_fingerprint(r.text)
    by_id = {r.doc_id: r.component_id for r in rows.collect()}
    assert by_id[1] == by_id[2] == by_id[10] == 1 and by_id[9] == 8
    assert simhash.near_duplicates(none).count() == 0


def linked(spark, values, distance):
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in sorted(set(signed))], "fp bigint")
    found = {r.node: r.root for r in simhash.components(simhash.near_links(frame, distance)).collect()}
    roots = [found.get(v, v) for v in signed]
    first = {}
    return [first.setdefault(r, k) for k, r in enumerate(roots)]


def test_links_like_all_pairs(spark):
    rng = random.Random(9)
    values = [rng.getrandbits(64) for _ in range(60)]
    for v in values[:40]:  # chains of up to three bits a step
        for _ in range(4):
            for _ in range(rng.randint(1, 3)):
                v ^= 1 << rng.randrange(64)
            values.append(v)
    values += [0, 1, 3, 7, (1 << 64) - 1, 1 << 63]
    for distance in (1, 2, 3):
        assert linked(spark, values, distance) == groups(values, distance)


def test_hot_variant_links_like_all_pairs():
    rng = random.Random(3)
    members = sorted({rng.getrandbits(12) << 3 for _ in range(1500)})
    assert len(members) > simhash.SMALL
    links = simhash.links_of(np.array(members, np.uint64), (1 << 33) - 1, 2)
    assert len(links) < len(members)
    parent = list(range(len(members)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        assert (members[a] ^ members[b]).bit_count() <= 2
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert [root(x) for x in range(len(members))] == groups(members, 2)


# top-k


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(x) for x in rng.normal(size=6)], "x") for k in range(300)]
    rows += [(300, rows[5][1], "y"), (301, rows[5][1], "y"), (302, None, "n"), (303, [1.0, None], "n"), (304, [float("nan")], "n"),
             (305, [float("inf")], "n"), (306, [], "e"), (307, [1.0], "short"), (None, [1.0] * 6, "i")]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank string")
    good = [(k, [int(np.floor(256 * x)) for x in v]) for k, v, t in rows if k is not None and t != "n"]
    want = []
    for q, v in good:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), k) for k, w in good if k != q)
            want += [(q, i + 1, k, -s) for i, (s, k) in enumerate(scored[:5])]
    got = top_k.search(frame, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert top_k.search(frame.limit(0), F.lit(True)).count() == 0
    assert top_k.search(frame.limit(3), F.lit(True)).count() == 6


# archives


def pages(spark):
    trap = "x" * 60 + "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" + "y" * 60
    half = "z" * 90 + "WARC/1.0\r\n" * 3 + "\r\n\r\n"
    big = "".join(f"line {k}\r\n\r\n" for k in range(5000))
    rows = [(k, f"http://e.x/{k}", f"<p>{k}</p>" * 40) for k in range(30)]
    rows += [(40, None, None), (41, "bad\r\nWARC/1.0\r\n", ""), (42, "u", "short"), (43, "u", "short"), (44, "u", trap), (45, "u", trap),
             (46, "u", half), (47, "u", big), (48, "u", big), (49, "", "é" * 70), (50, "u", "é" * 70), (50, "u", "é" * 70), (None, "u", "gone")]
    # one id with two payloads, both of which others revisit; payloads of rows without an id
    rows += [(60, "u", "A" * 200), (60, "u", "B" * 300), (61, "u", "A" * 200), (62, "u", "B" * 300), (63, "u", "B" * 300)]
    rows += [(None, "u", "A" * 200), (None, None, "C" * 150), (None, None, "C" * 150)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("record_type", F.lit("odd"))


def wanted(rows):
    out = []
    for r in rows:
        body = (r.html or "").encode()
        first = min((x.page_id for x in rows if x.page_id is not None and (x.html or "") == (r.html or "")), default=None)
        again = len(body) >= 100 and first is not None and (r.page_id is None or first < r.page_id)
        out.append((r.page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_archives(spark):
    rows = pages(spark)
    want = wanted(rows.collect())
    got = warc.round_trip(rows)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert warc.round_trip(rows.limit(0)).count() == 0


def test_archives_in_small_splits(spark):
    """Records and payloads that go over the ends of many splits of one file."""
    rows = pages(spark).coalesce(1)
    path = store.shared_folder(spark)
    records = warc.records(rows).coalesce(1)
    records.write.option("lineSep", warc.END).text(path)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = sorted(map(tuple, warc.catalogue(spark, path).collect()), key=str)
        payloads = {(r.page_id, hashlib.sha256(r.payload).hexdigest()) for r in warc.read(spark, path).filter("payload is not null").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    want = wanted(pages(spark).collect())
    assert got == want and payloads == {(w[0], w[2]) for w in want if w[3] == "response"}


# pipeline


def test_stages_like_plain_versions(spark, folder):
    import re

    from test_suffix_dedup import brute_words
    from test_texts import plain_measures, plain_spans

    from tonegauge.llm import secret_scan

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    (_, quality), (_, near), (_, repeats), (_, secrets), (_, packed) = corpus_pipeline.STAGES

    kept = store.stored(quality(spark, docs, folder))
    now = {r.doc_id: r.text for r in kept.collect()}
    failed = {d for d, t in rows.items() if (m := plain_measures(t))[0] < 50 or 100 * m[4] > 50 * m[0]}
    assert kept.columns == columns and not failed & set(now)

    single = store.stored(near(spark, kept, folder))
    ids = sorted(now)
    firsts = {ids[k] for k in groups([plain_fingerprint(now[d]) for d in ids], 2)}
    now = {r.doc_id: r.text for r in single.collect()}
    assert single.columns == columns and set(now) == firsts

    cut = store.stored(repeats(spark, single, folder))
    ids = sorted(now)
    want = dict(zip(ids, (k.decode(errors="ignore") for k in brute_words([now[d] for d in ids], 400, 51)), strict=True))
    now = {r.doc_id: r.text for r in cut.collect()}
    assert cut.columns == columns and now == want and all(r.n_chars == len(r.text) for r in cut.collect())

    clean = store.stored(secrets(spark, cut, folder))
    assert clean.columns == columns
    for r in clean.collect():
        if not plain_spans(now[r.doc_id]) and not secret_scan.Scanner().spans(now[r.doc_id]):
            assert r.text == now[r.doc_id]
        else:
            assert "[SECRET]" in r.text and not re.search("AKIA[A-Z0-9]{16,}", r.text)
    parts = packed(spark, clean, folder)
    assert {r.doc_id for r in parts.select("doc_id").collect()} == set(now)


def test_stages_take_odd_rows(spark, odd, none, folder):
    for rows in (odd, none):
        docs = rows.withColumn("n_chars", F.char_length("text").cast("bigint"))
        for _, stage in corpus_pipeline.STAGES:
            docs = store.stored(stage(spark, docs, folder))
    assert docs.count() == 0


def test_stages_leave_clashing_columns_alone(spark, folder):
    names = ["kept", "n_words", "_words", "spans", "n_bytes", "redacted", "_row", "_text", "fp", "rest", "c0_", "text_"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("*", *[F.concat(F.lit(n), "doc_id").alias(n) for n in names])
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = store.stored(stage(spark, docs, folder))
        assert docs.columns == columns
    left = docs.collect()
    assert left and all(r[n] == f"{n}{r.doc_id}" for r in left for n in names)
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, folder).select("doc_id").collect()} == {r.doc_id for r in left}


def test_operators_take_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "a b c " * 30, "x"), (2, None, "y")], "doc_id bigint, text string, other string")
    for n in ("_text", "text_", "fp", "_id", "body", "kind", "ids_crc32_"):
        named = rows.withColumnRenamed("other", n)
        found = [
            simhash.near_duplicates(named), suffix_dedup.remove_repeats(named, words=5), secret_scan.scan(named), quality.judged(named),
            periodic_runs.find_runs(named), packing.pack(named, tokenizer("byte_bpe_50k.json")), pieces.encode(named, tokenizer("piece_bpe_32k.model")),
        ]
        for f in found:
            assert n in f.columns and {r[n] for r in f.collect()} == {"x", "y"}


def test_stages_keep_one_row_of_each_text(spark, folder):
    """Repeated rows, rows without an id, and ids that carry two texts: every text is left once and whole."""
    import random

    def prose(seed):
        letters = random.Random(seed)
        return " ".join("".join(letters.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(150))

    a, b, c, d, e, f, g = map(prose, range(7))
    rows = [(4, a), (4, a), (None, b), (None, b), (2, c), (None, c), (1, d), (5, d), (5, e), (6, f), (6, g)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_chars", F.char_length("text").cast("bigint"))
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = store.stored(stage(spark, docs, folder))
        assert docs.columns == columns
    want = [(4, a), (None, b), (2, c), (1, d), (5, e), (6, f), (6, g)]
    assert sorted(map(str, docs.select("doc_id", "text").collect())) == sorted(f"Row(doc_id={i}, text={t!r})" for i, t in want)
    parts = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in parts.select("doc_id").collect()} == {i for i, _ in want}
