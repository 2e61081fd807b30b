"""The trie of conversation prefixes, with sums over subtrees by heavy-path decomposition.

A node is a distinct sequence of first turns. Of its children the one with most conversations goes on along its path; all
others begin paths of their own. Going down, conversations at least halve at each such beginning, so no node has more paths
above it than the logarithm of their number. Sums of whole paths are handed to the nodes they hang from, in that many rounds
over paths alone; then each path is an array, and sums from its end give all its nodes their subtrees.

A turn stands for its SHA-256, a sequence for two 64-bit exclusive ors of hashes of place and turn, which add up over any
range: a conversation of any length is worked on in pieces.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, ordered
from .components import connected_components
from .merkle import CRC32_SQL

ROOT = "0:0:0"
MOST_INHERITED = 8
FAMILY = 5


def turns(conversations: DataFrame) -> DataFrame:
    """Per row with a conv_id: conv_id, index from 0 in order of turn, sha, the turn's digest, and bytes, its text's length."""
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    sha = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.select(conversations["conv_id"].alias("conv_id"), conversations["turn"].alias("turn"), sha.alias("sha"), F.octet_length(text).cast("long").alias("bytes"))
    rows = common.materialised(rows.where("conv_id is not null"))  # narrow; texts are read once
    return ordered.numbered(rows, ["conv_id"], ["turn", "sha"]).select("conv_id", "index", "sha", "bytes")


def inherited(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.crc32(conv_id.cast("string")) % (MOST_INHERITED + 1)


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``own``, the result of ``turns``: the rebuilt turns (conv_id, depth, sha, bytes), and all conversations with their length."""
    counts = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = counts.withColumns({"first": F.col("conv_id") - F.col("conv_id") % FAMILY, "h": inherited(F.col("conv_id"))})
    bases = counts.select(F.col("conv_id").alias("first"), F.col("n").alias("base_n"))
    taken = F.least(F.col("h"), F.coalesce("base_n", F.lit(0)))
    convs = convs.join(bases, "first", "left").select("conv_id", "first", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    convs = common.materialised(convs)
    early = own.where(F.col("index") < MOST_INHERITED).withColumnRenamed("conv_id", "first")
    begun = convs.join(early, "first").where("index < h").select("conv_id", (F.col("index") + 1).alias("depth"), "sha", "bytes")
    rest = own.join(convs, "conv_id").where("index >= h").select("conv_id", (F.col("index") - F.col("h") + F.col("taken") + 1).alias("depth"), "sha", "bytes")
    return begun.unionByName(rest), convs.select("conv_id", "length")


def _node(depth: Column, a: Column, b: Column) -> Column:
    return F.concat_ws(":", depth.cast("string"), F.hex(a), F.hex(b))


def prefixes(seqs: DataFrame) -> DataFrame:
    """Per rebuilt turn: conv_id, depth, bytes, node, the name of the sequence up to it, and up, that of the sequence before it."""
    a, b = F.xxhash64("depth", "sha"), F.xxhash64("sha", F.lit("|"), "depth")
    rows = ordered.running(seqs, ["conv_id"], ["depth"], xors={"a": a, "b": b})
    before = (F.col("a").bitwiseXOR(a), F.col("b").bitwiseXOR(b))
    up = F.when(F.col("depth") == 1, ROOT).otherwise(_node(F.col("depth") - 1, *before))
    return rows.select("conv_id", "depth", "bytes", _node(F.col("depth"), F.col("a"), F.col("b")).alias("node"), up.alias("up"))


def paths(nodes: DataFrame) -> DataFrame:
    """Per node of ``nodes`` (node, up, conv_id, n_convs): node, path. Chains that one conversation has alone are one link of a path from the start."""
    best = F.max_by("node", F.struct("n_convs", -F.col("conv_id")))  # the largest child; of several the one with the least conversation
    heavy = nodes.where("up is not null").groupBy("up").agg(best.alias("node"))
    alone = F.when(F.col("n_convs") == 1, F.concat(F.lit("c"), F.col("conv_id").cast("string"))).otherwise(F.col("node"))
    named = nodes.select("node", alone.alias("link"))
    edges = heavy.join(named, "node").join(named.toDF("up", "up_link"), "up").where("link <> up_link")
    roots = connected_components(edges.select("link", "up_link"), "link", "up_link")
    return named.join(roots.toDF("link", "path"), "link", "left").select("node", F.coalesce("path", "link").alias("path"))


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``nodes`` (node, up, depth, conv_id, n_convs and ``values``, numbers of their own) with ``values`` summed over their subtrees."""
    placed = common.materialised(nodes.join(paths(nodes), "node"))
    whole = placed.groupBy("path").agg(*(F.sum(v).alias(v) for v in values), F.min_by("up", "depth").alias("up"))
    parents = placed.select(F.col("node").alias("up"), F.col("path").alias("up_path"))
    own = common.materialised(whole.join(parents, "up", "left").select("path", "up", "up_path", *values))
    totals, before = own, None
    while True:  # each round carries sums one path further up
        state = totals.agg(*(F.sum(v) for v in values)).first()
        if state == before:
            break
        before = state
        light = totals.where("up_path is not null").groupBy(F.col("up_path").alias("path")).agg(*(F.sum(v).alias(f"_{v}") for v in values))
        more = {v: F.col(v) + F.coalesce(f"_{v}", F.lit(0)) for v in values}
        totals = common.materialised(own.join(light, "path", "left").withColumns(more).select(*own.columns))
    hung = totals.where("up is not null").groupBy(F.col("up").alias("node")).agg(*(F.sum(v).alias(f"_{v}") for v in values))
    ready = placed.join(hung, "node", "left").withColumn("_down", -F.col("depth"))
    sums = {f"{v}_below": F.col(v) + F.coalesce(f"_{v}", F.lit(0)) for v in values}
    found = ordered.running(ready, ["path"], ["_down"], sums=sums)
    return found.select(*(c for c in nodes.columns if c not in values), *(F.col(f"{v}_below").alias(v) for v in values))


def ends(last: DataFrame) -> DataFrame:
    """Per node of ``last`` (node, conv_id): node, ends_sha256, over the ids in ascending order, joined by commas. Ids are put together by
    ranges; what of a node lies in several is hashed piece by piece, so a task holds no more than a piece."""
    ranged = last.repartitionByRange("node", "conv_id").withColumn("part", F.spark_partition_id())
    texts = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = ranged.groupBy("node", "part").agg(texts.alias("ids"))

    def hashed(batches):
        node, digest = None, None
        for batch in batches:
            names, found = [], []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        names.append(node)
                        found.append(digest.hexdigest())
                    node, digest = name, hashlib.sha256()
                digest.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.string())], names=["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])

    together = pieces.repartition("node").sortWithinPartitions("node", "part").select("node", "ids")
    return together.mapInArrow(hashed, "node string, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without a conv_id belong to no conversation and are left out; null roles and texts are empty, a null turn comes
    first; of turns with one number the one with the lesser digest does. Repeated rows are turns of their own. Other columns
    are ignored. An empty table gives no rows, not even the root.
    """
    seqs, convs = rebuilt(turns(conversations))
    rows = common.materialised(prefixes(seqs))
    nodes = rows.groupBy("node").agg(F.min("up").alias("up"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("up"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("bytes"))
    nodes = common.materialised(nodes.unionByName(root))
    children = nodes.where("up is not null").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    # Written before it is grouped by parent: else Spark groups where it has joined, and all children of the root meet in one task.
    nodes = common.materialised(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).join(parents, "up", "left"))
    own = {"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")}
    summed = subtree_sums(nodes.withColumns(own).drop("bytes"), list(own))
    lengths = convs.withColumnRenamed("length", "depth")
    last = rows.join(lengths, ["conv_id", "depth"]).select("node", "conv_id").unionByName(convs.where("length = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    nothing = hashlib.sha256().hexdigest()
    found = summed.join(ends(last), "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(common.table(spark, sf_dir, "conversations"))


OP13_SQL = """
with own as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 as i,
    coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
counts as (select conv_id, count(*) as n from own group by conv_id),
hs as (select *, conv_id - conv_id % 5 as base, xor(CRC, 4294967295) % 9 as h from counts),
convs as (select c.*, least(h, coalesce(b.n, 0)) as taken from hs c left join (select conv_id as base, n from counts) b using (base)),
seqs as (
  select c.conv_id, i + 1 as d, role, text from convs c join own o on o.conv_id = c.base and i < h
  union all
  select c.conv_id, i - h + taken + 1, role, text from convs c join own o on o.conv_id = c.conv_id and i >= h),
chained as (
  select conv_id, d, strlen(text) as bytes, sha256(string_agg(sha256(strlen(role) || ':' || role || text), '') over (partition by conv_id order by d)) as node from seqs
  union all
  select conv_id, 0, 0, '' from convs),
linked as (select *, lag(node) over (partition by conv_id order by d) as up, lead(node) over (partition by conv_id order by d) as down from chained),
nodes as (
  select node, d, any_value(up) as up, any_value(bytes) as bytes, min(conv_id) as conv_id, count(*) as n_convs, count(distinct down) as n_children,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (down is null), '')) as ends_sha256
  from linked group by node, d),
below as (
  select a.node, sum((n.n_children = 0)::int) as n_leaves, sum((n.n_convs - 1) * n.bytes) as saved_tokens
  from nodes n join linked a on a.conv_id = n.conv_id and a.d <= n.d group by a.node)
select n.conv_id, n.d::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, n.ends_sha256
from nodes n join below using (node) left join nodes p on p.node = n.up
""".replace("CRC", CRC32_SQL.format("conv_id"))
