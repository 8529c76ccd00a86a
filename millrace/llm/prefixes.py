"""The trie of conversations' common beginnings, by adaptive radix trees over turn ids.

A turn is a 16-byte id, the first half of the SHA-256 of its role and text, and a
conversation the string of its turns' ids in big-endian order. Conversations with the
same turns are one class. Classes are cut into pieces of ``PIECE`` turns, each under the key of
the prefix before it, and dealt out by ranges of prefix and piece. A task puts its
pieces into radix trees; of these only byte depths that end a turn are nodes. A
node that several tasks found is summed up afterwards.

A prefix's key is the exclusive or of its turns' hashes, each hashed with its place, in
128 bits. It grows turn by turn, so that a conversation with very many turns is
dealt out over blocks of rows whose keys, turn numbers and word counts are carried on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.mixing import word_count
from millrace.llm.radix import Tree
from millrace.llm.store import stored

#: Bytes of a turn id, turns of a piece, keys of one tree.
WIDTH, PIECE, KEYS = 16, 32, 20_000
#: Conversations that begin alike stand in groups of so many ids; turns taken from the first, less one.
GROUP, HEADS = 20, 4
_KEY = ["depth", "h1", "h2"]


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes that name a role and a text."""
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.unhex(F.substring(digest, 1, 2 * WIDTH))


def _hashes(depth: Column, turn: Column) -> tuple[Column, Column]:
    return F.xxhash64(depth, turn), F.xxhash64(F.lit(7), turn, depth)


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, id, words``, narrow, so that no text is shuffled."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    return stored(
        conversations.where(F.col(conv).isNotNull()).select(
            F.col(conv).cast("long").alias("conv"),
            F.col(turn).alias("turn"),
            turn_id(*said).alias("id"),
            word_count(said[1]).alias("words"),
        )
    )


# --- rebuilt conversations ------------------------------------------------------------


def _plans(turns: DataFrame) -> DataFrame:
    """``conv, skipped, head, len``: how each conversation is rebuilt.

    ``head`` are the turns it takes over, with their place, in place of its own first
    ``skipped`` ones. Of a group's first conversation three turns are enough.
    """
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "id")
    firsts = (
        turns.where(F.col("conv") % GROUP == 0)
        .withColumn("nth", F.row_number().over(order))
        .where(F.col("nth") < HEADS)
        .groupBy(F.col("conv").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct(F.col("nth").cast("long").alias("depth"), "id", "words"))).alias("firsts"))
    )
    skipped = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("int")
    none = F.array().cast(firsts.schema["firsts"].dataType)
    return (
        turns.groupBy("conv").agg(F.count("*").alias("own"))
        .withColumn("base", F.col("conv") - F.col("conv") % GROUP)
        .withColumn("skipped", skipped)
        .join(firsts, "base", "left")
        .withColumn("head", F.slice(F.coalesce("firsts", none), 1, F.col("skipped")))
        .select("conv", "skipped", "head", (F.size("head") + F.greatest(F.col("own") - F.col("skipped"), F.lit(0))).cast("long").alias("len"))
    )


def _carried(blocks: DataFrame, **sums: Column) -> DataFrame:
    """What the earlier blocks of a conversation add up to, for those that have any.

    At most one conversation goes on from a block to the next, so the rows are no
    more than the blocks.
    """
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    merge = lambda n: F.bit_xor(n) if n.startswith("x") else F.sum(n)
    ends = blocks.groupBy("conv", "block").agg(*[c.alias(n) for n, c in sums.items()])
    rows = ends.select("conv", "block", *[merge(n).over(before).alias(n) for n in sums])
    return stored(rows.where(F.col(next(iter(sums))).isNotNull()))


def _paths(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """One row per turn of the rebuilt conversations.

    ``conv, len, depth, id, words, before`` (words of earlier turns), the prefix's key
    ``h1, h2`` and that of the one before, ``p1, p2``.
    """
    ranged = turns.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(
        "conv", F.col("turn").asc_nulls_first(), "id", "tie"
    )
    dealt = stored(ranged.withColumn("block", F.spark_partition_id()))
    inside = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "id", "tie")
    earlier = _carried(dealt, n=F.count("*"))
    head = F.col("head")
    total = lambda part, of: F.aggregate(part, F.lit(0).cast("long"), lambda t, x: of(t, x))
    keys = [lambda t, x, n=n: t.bitwiseXOR(_hashes(x["depth"], x["id"])[n]) for n in (0, 1)]
    words = lambda t, x: t + x["words"]
    numbered = (
        dealt.withColumn("nth", F.row_number().over(inside))
        .join(earlier, ["conv", "block"], "left")
        .withColumn("nth", F.col("nth") + F.coalesce("n", F.lit(0)))
        .join(plans, "conv")
        .where("nth > skipped")
        .withColumn("depth", F.size("head") + F.col("nth") - F.col("skipped"))
    )
    a1, a2 = _hashes(F.col("depth"), F.col("id"))
    own = stored(
        numbered.select(
            "conv", "block", "len", "depth", "id", "words", a1.alias("a1"), a2.alias("a2"),
            total(head, keys[0]).alias("b1"), total(head, keys[1]).alias("b2"), total(head, words).alias("b"),
        )
    )
    run = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = _carried(own, x1=F.bit_xor("a1"), x2=F.bit_xor("a2"), w=F.sum("words"))
    more = lambda n: F.coalesce(F.col(n), F.lit(0).cast("long"))
    grown = (
        own.withColumns({"r1": F.bit_xor("a1").over(run), "r2": F.bit_xor("a2").over(run), "r": F.sum("words").over(run)})
        .join(earlier, ["conv", "block"], "left")
        .withColumn("h1", F.col("r1").bitwiseXOR(more("x1")).bitwiseXOR(F.col("b1")))
        .withColumn("h2", F.col("r2").bitwiseXOR(more("x2")).bitwiseXOR(F.col("b2")))
        .withColumn("before", F.col("r") + more("w") + F.col("b") - F.col("words"))
    )
    taken = plans.select("conv", "len", "head", F.explode("head").alias("t")).select(
        "conv", "len", "t.depth", "t.id", "t.words", F.slice("head", 1, F.col("t.depth").cast("int")).alias("head")
    )
    a = _hashes(F.col("depth"), F.col("id"))
    taken = taken.select(
        "conv", "len", "depth", "id", "words", (total(head, words) - F.col("words")).alias("before"),
        total(head, keys[0]).alias("h1"), total(head, keys[1]).alias("h2"), a[0].alias("a1"), a[1].alias("a2"),
    )
    rows = grown.select(*taken.columns).union(taken)
    return stored(
        rows.withColumns({"p1": F.col("h1").bitwiseXOR(F.col("a1")), "p2": F.col("h2").bitwiseXOR(F.col("a2"))}).drop("a1", "a2")
    )


# --- radix trees ----------------------------------------------------------------------

_NODES = "depth long, h1 long, h2 long, p1 long, p2 long, words long, before long, n long, conv long"


def _tree_nodes(tile: tuple | None, tree: Tree) -> Iterator[tuple]:
    """The nodes of a tree at the ends of turns: sums of members, least member, and their turn's own columns."""
    start, t1, t2 = tile or (0, 0, 0)
    totals: dict[int, list] = {}
    for node, low, high in tree.upwards():
        found = [totals.pop(id(kid)) for _, kid in node.pairs()]
        if node.end:
            found.append(node.end)
        whole = [sum(f[0] for f in found), min(f[1] for f in found), found[0][2]]
        totals[id(node)] = whole
        n, conv, turns = whole
        for k in range(low // WIDTH, high // WIDTH):
            turn = turns[k]
            p1, p2 = (turns[k - 1]["h1"], turns[k - 1]["h2"]) if k else (t1, t2)
            yield start + k + 1, turn["h1"], turn["h2"], p1, p2, turn["words"], turn["before"], n, conv


def _grow(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the pieces, which come in the order of their tiles and keys."""
    schema = pa.schema([(c.split()[0], pa.int64()) for c in _NODES.split(", ")])
    tile, tree, made = None, Tree(), []

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    for part in source:
        for row in part.to_pylist():
            own = (row["start"], row["t1"], row["t2"])
            if own != tile or tree.keys >= KEYS:
                made.extend(_tree_nodes(tile, tree))
                tile, tree = own, Tree()
            place = tree.insert(row["key"])
            if place:
                place[:2] = place[0] + row["n"], min(place[1], row["conv"])
            else:
                place += [row["n"], row["conv"], row["turns"]]
            if len(made) >= KEYS:
                yield batch(made)
                made = []
    made.extend(_tree_nodes(tile, tree))
    yield batch(made)


def _nodes(chosen: DataFrame) -> DataFrame:
    """Every distinct prefix of the classes with its members and its least member."""
    turn = F.struct("depth", "id", "h1", "h2", "words", "before", "p1", "p2")
    key = F.aggregate("items", F.lit(b""), lambda t, x: F.concat(t, x["id"]))
    pieces = (
        chosen.groupBy("conv", F.floor((F.col("depth") - 1) / PIECE).alias("piece"))
        .agg(F.sort_array(F.collect_list(turn)).alias("items"), F.first("k").alias("k"))
        .select(
            (F.col("piece") * PIECE).alias("start"), F.col("items")[0]["p1"].alias("t1"), F.col("items")[0]["p2"].alias("t2"),
            key.alias("key"), "conv", "k",
            F.transform("items", lambda x: F.struct(*[x[c].alias(c) for c in ("h1", "h2", "words", "before")])).alias("turns"),
        )
    )
    tile = ["start", "t1", "t2", "key"]
    distinct = pieces.groupBy(*tile).agg(F.sum("k").alias("n"), F.min("conv").alias("conv"), F.any_value("turns").alias("turns"))
    found = distinct.repartitionByRange(*tile).sortWithinPartitions(*tile).mapInArrow(_grow, _NODES)
    same = [F.any_value(c).alias(c) for c in ("p1", "p2", "words", "before")]
    return stored(found.groupBy(*_KEY).agg(*same, F.sum("n").alias("n"), F.min("conv").alias("conv")))


# --- whole nodes ----------------------------------------------------------------------


def _digest(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each class's joined ids, which come in order; one hash is open at a time."""
    names = [*_KEY, "ends"]
    now, state = None, None

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], names)

    for part in source:
        made = []
        for row in part.to_pylist():
            own = (row["depth"], row["h1"], row["h2"])
            if own == now:
                state.update(b",")
            else:
                if state is not None:
                    made.append((*now, state.hexdigest()))
                now, state = own, hashlib.sha256()
            state.update(row["ids"].encode())
        yield batch(made)
    yield batch([] if state is None else [(*now, state.hexdigest())])


def _ends(ends: DataFrame) -> DataFrame:
    """``depth, h1, h2, ends``: the hash of the ids of the conversations that end at a node.

    A hash has to see all ids in order. They are joined to strings of up to 4,096 ids
    first, and the task of a class only feeds these to one hash, so it holds no group.
    """
    chunk = F.expr("shiftright(conv, 12)")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    chunks = ends.groupBy(*_KEY, chunk.alias("chunk")).agg(ids.alias("ids"))
    ordered = chunks.repartition(*_KEY).sortWithinPartitions(*_KEY, "chunk")
    return ordered.mapInArrow(_digest, "depth long, h1 long, h2 long, ends string")


def prefix_trie(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Per node ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Conversation c is rebuilt as the first h turns of conversation ``c - c % 20``, with h =
    ``crc32(c) % 4``, then its own turns after its first h. Turns stand in order of ``turn``, null
    first; turns of one number by their id, so repeated rows are turns of their own. Null roles and
    texts are empty; rows without a conversation are left out. A node is a distinct
    sequence of first turns of rebuilt conversations, from the empty one; its members are
    all that begin with it. ``saved_tokens`` sums, over the nodes from it
    downwards, the words of the last turn for each member but one. An empty
    table gives an empty one; other columns are not read.
    """
    turns = _turns(conversations, conv, turn, role, text)
    plans = stored(_plans(turns))
    paths = _paths(turns, plans)
    zero = [F.lit(0).cast("long").alias(c) for c in (*_KEY, "total")]
    last = (F.col("before") + F.col("words")).alias("total")
    ends = stored(
        paths.where("depth = len").select("conv", *_KEY, last).union(plans.where("len = 0").select("conv", *zero))
    )
    classes = stored(
        ends.groupBy(*_KEY).agg(F.count("*").alias("k"), F.min("conv").alias("conv"), F.any_value("total").alias("total"))
    )
    chosen = stored(paths.drop("len").join(classes.select("conv", "k"), "conv"))
    nodes = _nodes(chosen)

    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(
        F.count("*").alias("children")
    )
    # a conversation is the least member of its nodes from some depth on
    owned = nodes.groupBy("conv").agg(F.min(F.struct("depth", "before")).alias("owned"))
    weighed = stored(
        classes.join(children, _KEY, "left")
        .join(owned, "conv", "left")
        .select("conv", "k", "total", F.col("children").isNull().cast("long").alias("leaf"), "owned")
    )
    # words that members have from a node on, less those of the nodes, counted at their least member
    fresh = F.when(F.col("owned").isNull(), F.lit(0).cast("long")).otherwise(
        F.col("total") - F.when(F.col("depth") >= F.col("owned.depth"), F.col("before")).otherwise(F.col("owned.before"))
    )
    shares = chosen.select("conv", *_KEY, "before").join(weighed, "conv")
    tops = weighed.withColumns({c: F.lit(0).cast("long") for c in (*_KEY, "before")}).select(*shares.columns)
    sums = (
        shares.union(tops).withColumn("saved", F.col("k") * (F.col("total") - F.col("before")) - fresh)
        .groupBy(*_KEY).agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"))
    )
    root = plans.agg(F.count("*").alias("n"), F.min("conv").alias("conv")).where("n > 0")
    blank = lambda kind: F.lit(None).cast(kind)
    root = root.select(*[z for z in zero[:3]], blank("long").alias("p1"), blank("long").alias("p2"), "n", "conv")
    every = stored(nodes.select(*root.columns).union(root))

    names = ["p1", "p2", "n", "conv", "children", "leaves", "saved", "ends"]
    parts = [every, children, sums, _ends(ends)]
    whole = None
    for part in parts:
        kinds = {n: "string" if n == "ends" else "long" for n in names}
        row = part.select(*_KEY, *[F.col(n) if n in part.columns else blank(kinds[n]).alias(n) for n in names])
        whole = row if whole is None else whole.union(row)
    joined = whole.groupBy(*_KEY).agg(*[F.max(n).alias(n) for n in names])
    above = every.select(
        (F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv").alias("parent")
    )
    return joined.join(above, ["depth", "p1", "p2"], "left").select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.coalesce("children", F.lit(0).cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
