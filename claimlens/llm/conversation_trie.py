"""Prefix trie of conversations, with subtree sums rolled up by bands of depth.

A node is a distinct sequence of first turns; its members are the conversations that start with it.
Nodes are keyed by 128 bits: the XOR of two 64-bit hashes of (depth, digest of the turn) over the
sequence, so that running keys come from sums over blocks of turns and a conversation of any length is
never one group.

Subtree sums: depths are cut into bands of ``BAND``. Inside a band every node adds itself to its
ancestors in that band, so a node is exploded to fewer than ``BAND`` rows. What a band's roots then hold
is the sum of their own band. The roots alone form a trie of 1 / BAND the depth, which is summed the
same way; each completed root total is then added to its ancestors in the band above it. Rounds grow with
the logarithm of the depth, and no node is ever exploded to all of its ancestors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import prepared, text_or_empty
from claimlens.session import stage

BAND = 8
BLOCK = 512 * BAND  # turns in one window
TURNS = 1024  # values of ``turn`` in one window
IDS = 8192  # values of ``conv_id`` in one piece of a list of members

_KEY = ["depth", "k1", "k2"]


# --- turns in order ---------------------------------------------------------------------------


def ordered(rows: DataFrame) -> DataFrame:
    """(conv_id, position from 1, digest, n_words), staged, of rows (conv_id, turn, role, text).

    By ``turn``, null first; equal turns by their digest, a fixed order. A null role or text is an empty
    one, equal rows are turns of their own, rows without a conv_id are left out. Other columns are not
    read. A window holds the rows of one conversation in a range of ``turn``."""
    prepared(rows.sparkSession)
    role, text = text_or_empty("role"), text_or_empty("text")
    marked = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(_div("turn", TURNS), F.lit(-(1 << 62))).alias("bucket"),
        F.unhex(F.md5(marked)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("n_words"),
    )
    turns = stage(turns, "trie-turns")
    counts = turns.groupBy("conv_id", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = _before(counts, "bucket", {"n": F.sum})
    place = Window.partitionBy("conv_id", "bucket").orderBy(F.col("turn").asc_nulls_first(), "digest")
    numbered = turns.join(before, ["conv_id", "bucket"]).select(
        "conv_id", (F.col("n") + F.row_number().over(place)).alias("position"), "digest", "n_words"
    )
    return stage(numbered, "trie-ordered")


def with_shared_heads(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt to share their beginnings: the first h turns of conversation
    c - c % every (all if it has fewer, none if it is absent), then c's own turns after its first h, where
    h = crc32(c) % most. Gives the turns in new positions, and the ids (turnless ones too)."""
    head = (F.crc32(F.col("conv_id").cast("string")) % most).cast("bigint")
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("position") < most))
    heads = heads.withColumnRenamed("conv_id", "base")
    lengths = heads.groupBy("base").agg(F.max("position").alias("there"))
    ids = stage(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select("conv_id"), "trie-ids")

    own = turns.withColumns({"base": base, "head": head}).where("position > head").join(lengths, "base", "left")
    own = own.select(
        "conv_id",
        (F.col("position") - F.col("head") + F.least("head", F.coalesce("there", F.lit(0)))).alias("position"),
        "digest",
        "n_words",
    )
    shared = ids.withColumns({"base": base, "head": head}).join(heads, "base").where("position <= head")
    return own.unionByName(shared.select(own.columns)), ids


def _div(name: str, by: int) -> Column:
    return F.expr(f"cast({name} as bigint) div {by}L")


def _before(totals: DataFrame, place: str, values: dict, width: int = 1024) -> DataFrame:
    """(conv_id, place, values): the totals of a conversation's places before each, over blocks of places."""
    block = F.expr(f"{place} div {width}L")
    inside = Window.partitionBy("conv_id", "__block").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy("conv_id").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__block", block)
    none = F.lit(0).cast("bigint")
    blocks = totals.groupBy("conv_id", "__block").agg(*(how(c).alias(c) for c, how in values.items()))
    blocks = blocks.select(
        "conv_id", "__block", *(F.coalesce(how(c).over(above), none).alias(f"__{c}") for c, how in values.items())
    )
    within = totals.select(
        "conv_id", "__block", place, *(F.coalesce(how(c).over(inside), none).alias(c) for c, how in values.items())
    )

    def both(c: str, how) -> Column:
        return F.col(c) + F.col(f"__{c}") if how is F.sum else F.col(c).bitwiseXOR(F.col(f"__{c}"))

    return within.join(blocks, ["conv_id", "__block"]).select(
        "conv_id", place, *(both(c, how).alias(c) for c, how in values.items())
    )


# --- the trie ---------------------------------------------------------------------------------


def trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, position 1 … n without gaps, digest, n_words), of the
    conversations ``ids`` (conv_id, distinct; those without turns are members of the root).

    Per node: conv_id, its smallest member; depth; parent_conv_id, the parent's (root: null); n_convs, its
    members; n_children; n_leaves, nodes without children in its subtree, itself included; saved_tokens, the
    sum over its subtree of each node's (n_convs - 1) x words of its last turn (root: none); ends_sha256,
    hex digest of the ids of the conversations that end here, ascending, with commas. (depth, conv_id)
    identifies a node. No conversation, no node."""
    spark = prepared(turns.sparkSession)
    steps = turns.select(
        "conv_id",
        F.col("position").alias("depth"),
        F.expr(f"(position - 1) div {BLOCK}L").alias("block"),
        *(F.xxhash64(F.lit(seed), "position", "digest").alias(f"g{seed}") for seed in (1, 2)),
        "n_words",
    )
    steps = stage(steps, "trie-steps")

    root = ids.groupBy(F.lit(0).cast("bigint").alias("depth")).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")
    )
    zero = F.lit(0).cast("bigint")
    root = root.select(
        "depth", zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", zero.alias("n_words"),
        F.expr("cast(array() as array<struct<k1: bigint, k2: bigint>>)").alias("path"),
    )
    bands = stage(_bands(_keys(steps)), "trie-bands")
    nodes = _paths(bands, "n_words").groupBy(_KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("n_words").alias("n_words"),
        F.first("path").alias("path"),
    )
    nodes = stage(nodes.unionByName(root.select(nodes.columns)), "trie-nodes")

    parent = F.try_element_at("path", F.lit(-1))
    children = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), parent["k1"].alias("k1"), parent["k2"].alias("k2"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    nodes = nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = stage(nodes, "trie-children")

    weighed = nodes.select(
        *_KEY,
        "path",
        (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved_tokens"),
    )
    sums = stage(_subtree_sums(weighed, bands), "trie-sums")
    ends = _ends(steps, ids)
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    found = nodes.withColumns({"p1": parent["k1"], "p2": parent["k2"]}).drop("path")
    found = found.join(parents, ["depth", "p1", "p2"], "left").join(sums, _KEY).join(ends, _KEY, "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", empty).alias("ends_sha256"),
    )


def _keys(steps: DataFrame) -> DataFrame:
    """Steps with the keys of their node (k1, k2) and of its parent (p1, p2)."""
    totals = steps.groupBy("conv_id", "block").agg(F.bit_xor("g1").alias("c1"), F.bit_xor("g2").alias("c2"))
    before = _before(totals, "block", {"c1": F.bit_xor, "c2": F.bit_xor})
    run = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    keyed = steps.join(before, ["conv_id", "block"])
    keyed = keyed.withColumns({f"k{i}": F.col(f"c{i}").bitwiseXOR(F.bit_xor(f"g{i}").over(run)) for i in (1, 2)})
    return keyed.withColumns({f"p{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"g{i}")) for i in (1, 2)})


def _bands(steps: DataFrame) -> DataFrame:
    """One row per conversation and band: its steps, at most BAND, in order."""
    names = [c for c in ("depth", "k1", "k2", "p1", "p2", "n_words") if c in steps.columns]
    return steps.groupBy("conv_id", "block", F.expr(f"(depth - 1) div {BAND}L").alias("band")).agg(
        F.sort_array(F.collect_list(F.struct(*names))).alias("steps")
    )


def _paths(bands: DataFrame, *carried: str) -> DataFrame:
    """One row per step: the key of its node, and those of its ancestors from the root of the parent's band
    down to the parent. A band's root is the last step of the band above, so its path is that whole band."""
    first = F.col("steps")[0]
    above = F.array(F.struct(first["p1"].alias("k1"), first["p2"].alias("k2")))
    keys = F.arrays_zip(F.col("steps.k1").alias("k1"), F.col("steps.k2").alias("k2"))
    rows = bands.select("conv_id", above.alias("above"), keys.alias("keys"), F.posexplode("steps").alias("at", "step"))
    return rows.select(
        "conv_id",
        *(F.col("step")[c].alias(c) for c in (*_KEY, *carried)),
        F.concat("above", F.slice("keys", F.lit(1), F.col("at"))).alias("path"),
    )


def _roots_of(bands: DataFrame) -> DataFrame:
    """Bands of the trie of band roots: a full band ends in the root of the next."""
    first, last = F.col("steps")[0], F.element_at("steps", -1)
    full = bands.where(F.size("steps") == BAND)
    return _bands(
        full.select(
            "conv_id",
            F.expr(f"band div {BLOCK}L").alias("block"),
            (F.col("band") + 1).alias("depth"),
            *(last[k].alias(k) for k in ("k1", "k2")),
            *(first[p].alias(p) for p in ("p1", "p2")),
        )
    )


def _subtree_sums(nodes: DataFrame, bands: DataFrame) -> DataFrame:
    """(depth, k1, k2, n_leaves, saved_tokens): the sums over each node's subtree.

    ``nodes`` has every node with its path and its own values, ``bands`` the steps that the paths of the
    next round are made from."""
    values = ["n_leaves", "saved_tokens"]
    own = nodes.select(*_KEY, *values)
    within = _added(own.unionByName(_upwards(nodes.where(F.col("depth") % BAND != 0), values)), values)
    if nodes.agg(F.max("depth")).first()[0] in (None, *range(BAND)):
        return within
    within = stage(within, "trie-within")
    is_root = F.col("depth") % BAND == 0

    upper = stage(_roots_of(bands), "trie-roots")
    paths = _paths(upper).groupBy(_KEY).agg(F.first("path").alias("path"))
    roots = within.where(is_root).withColumn("depth", F.expr(f"depth div {BAND}L"))
    none = F.expr("cast(array() as array<struct<k1: bigint, k2: bigint>>)")
    roots = roots.join(paths, _KEY, "left").withColumn("path", F.coalesce("path", none))
    done = _subtree_sums(stage(roots, "trie-root-nodes"), upper)
    done = stage(done.withColumn("depth", F.col("depth") * BAND), "trie-done")

    # Completed totals go to the ancestors inside the band above; its root has its own total already.
    rising = done.where("depth > 0").join(nodes.where(is_root).select(*_KEY, "path"), _KEY)
    rising = _upwards(rising, values).where(~is_root)
    return _added(within.where(~is_root).unionByName(rising), values).unionByName(done)


def _upwards(nodes: DataFrame, values: list[str]) -> DataFrame:
    """The values of each node, once for every ancestor on its path."""
    top = F.expr(f"(depth - 1) div {BAND}L * {BAND}L")
    rows = nodes.where("depth > 0").select(top.alias("top"), *values, F.posexplode("path").alias("at", "node"))
    return rows.select((F.col("top") + F.col("at")).alias("depth"), "node.k1", "node.k2", *values)


def _added(rows: DataFrame, values: list[str]) -> DataFrame:
    return rows.groupBy(_KEY).agg(*(F.sum(v).alias(v) for v in values))


def _ends(steps: DataFrame, ids: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the nodes where conversations end.

    Ids are sorted and joined in pieces of a range of ids; a node's pieces, in order, pass through its
    digest as a stream, however many they are."""
    zero = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    parts = steps.select("conv_id", "g1", "g2", one.alias("n")).unionByName(
        ids.select("conv_id", zero.alias("g1"), zero.alias("g2"), zero.alias("n"))
    )
    last = parts.groupBy("conv_id").agg(F.sum("n").alias("depth"), F.bit_xor("g1").alias("k1"), F.bit_xor("g2").alias("k2"))
    listed = F.sort_array(F.collect_list("conv_id")).cast("array<string>")
    pieces = last.groupBy(*_KEY, F.expr(f"conv_id div {IDS}L").alias("piece")).agg(F.array_join(listed, ",").alias("ids"))
    pieces = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "piece").select(*_KEY, "ids")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, running = None, None
        for batch in batches:
            done = []
            for *key, listed in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if key != here:
                    if running is not None:
                        done.append((*here, running.hexdigest()))
                    here, running = key, hashlib.sha256(listed.encode())
                else:
                    running.update(b"," + listed.encode())
            yield _digests(done)
        if running is not None:
            yield _digests([(*here, running.hexdigest())])

    return pieces.mapInArrow(digest, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*_KEY, "ends_sha256"]
    )
