"""Prefix trie of conversations, from Spark SQL's ROLLUP over the ids of turns by their place.

A turn's id is a digest of its role and text, so texts are read once and never move. A conversation is laid out in blocks of
``width`` columns t1, t2, ... A block's rows are grouped by the block number, the node at which the block before ended, and
ROLLUP(t1, t2, ...): grouping_id tells how many leading columns a group has, so one aggregation gives the nodes of all depths
of all blocks. A node is named by a digest of the name of the block's first node and the ids that follow, so all blocks of long
conversations are grouped in the same job, whatever their number.

Sums over subtrees need no walk of the trie. Every conversation with a node's prefix is in the node's group, and each node of a
subtree belongs to one of them: its smallest conversation, which owns a chain of nodes down to its end. So

* n_leaves is the number of members that are the smallest conversation of a childless node, and
* saved tokens are the words of all members from the node on, less the words of the nodes that members own there.

Both are sums over the same ROLLUP, run a second time with what each conversation owns.

Defined results: turns are ordered by number (null first), then role, then digest of the text; null role or text is empty; rows
without a conversation id take no part; repeated rows are turns of their own; a conversation without turns ends at the root; an
empty table gives no row, no root either; other columns are ignored. What grows in one place: the 16-byte ids of one
conversation's turns, in a row. The ids that end in one node are hashed as a sorted stream and never gathered.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonegauge.llm.pivot_index import join_spread
from tonegauge.llm.store import stored

WIDTH = 8
#: Consecutive conversation ids whose decimal forms are joined before they are hashed.
IDS_A_PIECE = 4096


def digest(*parts: Column) -> Column:
    """16 bytes of a SHA-256 over parts that cannot run into each other."""
    return F.substring(F.unhex(F.sha2(F.concat_ws(",", *[F.hex(p) for p in parts]).cast("binary"), 256)), 1, 16)


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turns): each conversation's turns in order, as structs of ``id`` and ``words``."""
    said = F.coalesce(F.col(text), F.lit(""))
    who = F.coalesce(F.col(role), F.lit(""))
    words = F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    rows = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("turn"), who.alias("role"), F.sha2(said.cast("binary"), 256).alias("said"),
        words.alias("words"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "said", digest(F.col("role"), F.col("said")).alias("id"), "words")))
    return rows.groupBy("conv").agg(F.transform(ordered, lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def blocks_of(convs: DataFrame, width: int) -> DataFrame:
    """A row per conversation and block: (conv, total, last, block, prior, t1, ...). ``prior`` names the node before the block,
    ``last`` the one where the conversation ends. One without turns has one empty block, one that fills a block no further one."""
    ids = F.col("turns.id")
    parts = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size("turns") - 1) / width).cast("int"))),
        lambda k: F.slice(ids, k * width + 1, width),
    )
    named = F.aggregate(
        "parts", F.array(F.lit(b"")), lambda names, part: F.concat(names, F.array(name(F.element_at(names, -1), part)))
    )
    spread = convs.withColumn("parts", parts).withColumn("names", named).select(
        "conv", "total", "names", F.posexplode("parts").alias("block", "part")
    )
    return spread.select(
        "conv", "total", F.element_at("names", -1).alias("last"), "block", F.get("names", F.col("block")).alias("prior"),
        *[F.get("part", F.lit(k)).alias(f"t{k + 1}") for k in range(width)],
    )


def name(first: Column, ids: Column) -> Column:
    """The name of the node that ``ids`` lead to from the node named ``first``; no id leads nowhere."""
    joined = F.array_join(F.transform(ids, lambda x: F.hex(x)), ",")
    long = F.substring(F.unhex(F.sha2(F.concat(F.hex(first), F.lit(":"), joined).cast("binary"), 256)), 1, 16)
    return F.when(F.size(ids) > 0, long).otherwise(first)


def rolled(blocks: DataFrame, width: int, sums: dict[str, str]) -> DataFrame:
    """One row per node: its path in its block and ``sums``, SQL aggregates by name."""
    columns = [f"t{k + 1}" for k in range(width)]
    listed = ", ".join(columns)
    found = blocks.sparkSession.sql(
        f"""SELECT block, prior, array({listed}) AS path, grouping_id() AS left_out, {", ".join(f"{s} AS {n}" for n, s in sums.items())}
        FROM {{blocks}} GROUP BY block, prior, ROLLUP({listed})""",
        blocks=blocks,
    )
    # grouping_id has a one for each column that a group leaves out, the last ones
    held = F.lit(width) - F.bit_count("left_out")
    nodes = found.withColumn("held", held).withColumn("path", F.slice("path", 1, F.col("held")))
    # a group whose last column is null stands for conversations that end before; a block's first node is the last one's last
    real = F.when(F.col("held") == 0, F.col("block") == 0).otherwise(F.get("path", F.col("held") - 1).isNotNull())
    return nodes.filter(real).withColumn("depth", (F.col("block") * width + F.col("held")).cast("bigint"))


def ends(convs: DataFrame) -> DataFrame:
    """(name, ends_sha256): the conversations that end in a node, hashed as their ascending ids joined by commas."""
    piece = F.floor(F.col("conv") / IDS_A_PIECE)
    pieces = convs.groupBy(F.col("last").alias("name"), piece.alias("piece")).agg(
        F.array_join(F.sort_array(F.collect_set("conv")).cast("array<string>"), ",").alias("ids")
    )
    parts = int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    streamed = pieces.repartition(parts, "name").sortWithinPartitions("name", "piece")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            names, sums = [], []
            for own, ids in zip(batch.column("name").to_pylist(), batch.column("ids"), strict=True):
                if own != now:
                    if state:
                        names.append(now)
                        sums.append(state.hexdigest())
                    now, state = own, hashlib.sha256(ids.as_py().encode())
                else:
                    state.update(b"," + ids.as_py().encode())
            yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.binary()), "ends_sha256": pa.array(sums, pa.string())})
        if state:
            yield pa.RecordBatch.from_pydict({"name": pa.array([now], pa.binary()), "ends_sha256": pa.array([state.hexdigest()])})

    return streamed.mapInArrow(work, "name binary, ends_sha256 string")


def trie(convs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The nodes of the trie of (conv, turns), conversations being distinct integers: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    if not 1 <= width <= 63:
        raise ValueError("a block has 1 to 63 columns")
    words = F.aggregate("turns.words", F.lit(0).cast("bigint"), lambda a, b: a + b)
    convs = convs.select("conv", "turns", words.alias("total"))
    laid = stored(blocks_of(convs, width))
    first = rolled(laid, width, {"conv_id": "min(conv)", "n_convs": "count(*)", "words": "sum(total)"})
    above = F.when(F.col("held") > 1, name(F.col("prior"), F.slice("path", 1, F.greatest("held", F.lit(1)) - 1))).when(F.col("depth") > 0, F.col("prior"))
    nodes = stored(first.select("conv_id", "depth", "n_convs", "words", name(F.col("prior"), F.col("path")).alias("name"), above.alias("above")))

    # a conversation owns its nodes from the first one of which it is the smallest member
    chains = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "above")).alias("top"), F.max("depth").alias("deep"))
    heads = chains.select("conv_id", F.col("top.depth").alias("depth"), F.col("top.above").alias("name"), "deep")
    parents = nodes.select("name", F.col("conv_id").alias("parent_conv_id"))
    headed = stored(join_spread(heads.filter(F.col("depth") > 0), parents, "name", "conv_id").select("conv_id", "depth", "parent_conv_id"))
    branches = headed.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("branches"))
    owners = stored(heads.select("conv_id", F.col("depth").alias("top"), "deep"))

    # a conversation that ends in a node without children, as the smallest there, is a leaf
    leaf = owners.join(branches.withColumnRenamed("depth", "deep"), ["conv_id", "deep"], "left").select(
        F.col("conv_id").alias("conv"), "top", F.col("branches").isNull().alias("ends_branch")
    )
    lengths = convs.select("conv", "total", F.transform("turns", lambda t: t["words"]).alias("said"))
    whole = lengths.join(leaf, "conv", "left")
    before = F.aggregate(F.slice("said", 1, F.greatest(F.col("top") - 1, F.lit(0)).cast("int")), F.lit(0).cast("bigint"), lambda a, b: a + b)
    owned = stored(whole.select(
        "conv", F.when(F.col("top").isNull(), 0).otherwise(F.col("total") - before).cast("bigint").alias("owned"),
        F.coalesce("ends_branch", F.lit(False)).cast("bigint").alias("leaf"), "said", "total",
    ))
    second = rolled(laid.join(owned.select("conv", "owned", "leaf"), "conv"), width, {"conv_id": "min(conv)", "owned": "sum(owned)", "n_leaves": "sum(leaf)"})
    second = second.select("conv_id", "depth", "owned", "n_leaves")

    upto = F.aggregate(F.slice("said", 1, F.greatest(F.col("depth") - 1, F.lit(0)).cast("int")), F.lit(0).cast("bigint"), lambda a, b: a + b)
    own = owned.select(F.col("conv").alias("conv_id"), F.col("owned").alias("own"), "said", "total")
    members = F.col("words") - F.col("n_convs") * upto
    once = F.col("owned") - F.col("own") + F.col("total") - upto
    root_parent = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id"))
    return (
        nodes.join(second, ["conv_id", "depth"]).join(own, "conv_id")
        .join(headed, ["conv_id", "depth"], "left").join(branches, ["conv_id", "depth"], "left")
        .join(owners.select("conv_id", "deep"), "conv_id").join(ends(laid.filter(F.col("block") == 0)), "name", "left")
        .select(
            "conv_id", "depth", root_parent.alias("parent_conv_id"), "n_convs",
            (F.coalesce("branches", F.lit(0)) + (F.col("depth") < F.col("deep")).cast("bigint")).cast("bigint").alias("n_children"),
            "n_leaves", (members - once).cast("bigint").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def prefix_trie(turns: DataFrame, width: int = WIDTH, **columns: str) -> DataFrame:
    """The trie of a table of turns; ``columns``: names for ``conv``, ``turn``, ``role``, ``text``."""
    return trie(stored(sequences(turns, **columns)), width)
