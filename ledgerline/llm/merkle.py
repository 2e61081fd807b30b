"""A Merkle manifest of a dataset by superblock reduction.

Each source is a tree over its rows in the order of their ids, and the sources' roots are the leaves of one more. A tree of any
size is reduced by buckets of FANOUT ** LEVELS consecutive nodes: a bucket is collapsed by one call of applyInPandas, which gives
the bucket's root, and the roots are collapsed alike until one is left, so 4096 times fewer rows take part in each step. Proofs
go the other way: a bucket's nodes get their siblings within the bucket, followed by those of the bucket's root.

A proof is the texts of digests to the left and to the right of a node in its run, level by level; whoever holds a row and
its proof can fold it to the root without any other row.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, ordered

FANOUT = 16
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64  # digits of a digest


def leaf_of(values: list[Column]) -> Column:
    """The digest of a row: of each value its number of bytes, a colon and itself, or - for null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def levels_of(total: int, fanout: int = FANOUT) -> int:
    """Levels from ``total`` leaves to their root: none for a lone leaf."""
    n = 0
    while total > 1:
        total, n = -(-total // fanout), n + 1
    return n


def _run(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def collapsed(nodes: list[str], levels: int, fanout: int = FANOUT) -> list[list[str]]:
    """The digests of each level from ``nodes`` up, ``levels`` above it; a last run may be short, even of one."""
    found = [nodes]
    for _ in range(levels):
        below = found[-1]
        found.append([_run(below[k : k + fanout]) for k in range(0, len(below), fanout)])
    return found


def siblings(tree: list[list[str]], fanout: int = FANOUT) -> tuple[list[list[str]], list[list[str]]]:
    """Per node of the lowest level of ``tree``: what stands to its left, and to its right, in its run on each level."""
    runs = [["".join(level[k : k + fanout]) for k in range(0, len(level), fanout)] for level in tree[:-1]]
    lefts, rights = [], []
    for at in range(len(tree[0])):
        left, right = [], []
        for run in runs:
            at, slot = divmod(at, fanout)
            left.append(run[at][: HEX * slot])
            right.append(run[at][HEX * (slot + 1) :])
        lefts.append(left)
        rights.append(right)
    return lefts, rights


def _up(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Of ``nodes`` (grp, index, total, node) the root of each bucket, as nodes again. ``total`` tells how many a tree has on its level."""
    size = fanout**levels

    def collapse(key, part):
        total = int(part["total"].iloc[0])
        tree = collapsed(part.sort_values("index")["node"].tolist(), min(levels, levels_of(total, fanout)), fanout)
        return pd.DataFrame({"grp": [key[0]], "index": [key[1]], "total": [-(-total // size)], "node": tree[-1]})

    keyed = nodes.select("grp", F.floor(F.col("index") / size).alias("bucket"), "index", "total", "node")
    return keyed.groupBy("grp", "bucket").applyInPandas(collapse, "grp string, index long, total long, node string")


def _down(nodes: DataFrame, above: DataFrame, fanout: int, levels: int, carried: tuple = ()) -> DataFrame:
    """``nodes``, their texts ``carried`` beside them, with lefts and rights: their siblings in the bucket, then those of the bucket's root in ``above`` (grp, index, lefts, rights, root, subroot)."""
    size = fanout**levels

    def prove(key, part, upper):
        part = part.sort_values("index")
        tree = collapsed(part["node"].tolist(), min(levels, levels_of(int(part["total"].iloc[0]), fanout)), fanout)
        lefts, rights = siblings(tree, fanout)
        top = upper.iloc[0]
        more_left, more_right = list(top["lefts"]), list(top["rights"])
        found = part[["grp", "index", *carried]].assign(subroot=top["subroot"], root=top["root"])
        found["lefts"], found["rights"] = [x + more_left for x in lefts], [x + more_right for x in rights]
        return found

    keyed = nodes.withColumn("bucket", F.floor(F.col("index") / size)).groupBy("grp", "bucket")
    uppers = above.withColumnRenamed("index", "bucket").groupBy("grp", "bucket")
    fields = ", ".join(["grp string, index long", *(f"{c} string" for c in carried), "subroot string, root string, lefts array<string>, rights array<string>"])
    return keyed.cogroup(uppers).applyInPandas(prove, fields)


def _trees(nodes: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """``nodes``, the roots of their buckets, the roots of those ..., until each tree is one node; all but the first are written."""
    steps = [nodes]
    while True:
        steps.append(common.materialised(_up(steps[-1].where("total > 1") if len(steps) > 1 else steps[-1], fanout, levels)))
        if steps[-1].where("total > 1").isEmpty():
            return steps


def _proved(steps: list[DataFrame], finished: DataFrame, fanout: int, levels: int, carried: tuple = ()) -> DataFrame:
    """The first of ``steps`` with proofs; ``finished`` (grp, lefts, rights, root, subroot) is what goes on above a tree's root."""
    known = None
    for step in reversed(steps[1:]):
        done = step.where("total = 1").select("grp", "index").join(finished, "grp")
        known = done if known is None else done.unionByName(_down(step.where("total > 1"), known, fanout, levels))
    return _down(steps[0], known, fanout, levels, carried)


def leaves(docs: DataFrame, fields: tuple = FIELDS, shown: dict[str, Column] | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, source, leaf, the digest of ``fields``; with ``shown`` also shown, the digest with some fields as given there."""
    columns = [docs["doc_id"].alias("doc_id"), docs["source"].cast("string").alias("source"), leaf_of([docs[f] for f in fields]).alias("leaf")]
    if shown is not None:
        columns.append(leaf_of([shown.get(f, docs[f]) for f in fields]).alias("shown"))
    return docs.select(*columns)


def proofs(leaves: DataFrame, carried: tuple = (), fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Per row of ``leaves`` (doc_id, source, leaf): doc_id, leaf, ``carried`` (columns of text), subroot, root, lefts, rights.

    Rows of a source go by doc_id, nulls first, rows with one id by their digest; sources by the bytes of their names, null
    first. Repeated rows are a leaf each. An empty table gives no rows; columns that are not named are ignored. A source of any
    size is cut into buckets of fanout ** levels rows; numbering deals it out by ranges, so no task orders a whole source.
    """
    grp = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("grp")
    plain = common.materialised(leaves.select(grp, "doc_id", F.col("leaf").alias("node"), *carried))  # narrow; texts are read once
    nodes = common.materialised(ordered.numbered(plain, ["grp"], ["doc_id", "node"]))
    steps = _trees(nodes.select("grp", "index", "total", "node"), fanout, levels)
    subroots = steps[1].where("total = 1")
    for step in steps[2:]:
        subroots = subroots.unionByName(step.where("total = 1"))
    subroots = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("of"), "node")
    subroots = common.materialised(ordered.numbered(subroots, ["grp"], ["of"]))
    tops = _trees(subroots.select("grp", "index", "total", "node"), fanout, levels)
    none = F.array().cast("array<string>")
    ends = tops[-1].where("total = 1").select("grp", none.alias("lefts"), none.alias("rights"), F.col("node").alias("root"), F.lit("").alias("subroot"))
    above = _proved(tops, ends, fanout, levels).select("index", "lefts", "rights", "root")
    finished = common.materialised(subroots.join(above, "index").select(F.col("of").alias("grp"), "lefts", "rights", "root", F.col("node").alias("subroot")))
    # pandas would make numbers with nulls floating; ids go through it as texts
    texts = nodes.select("grp", "index", "total", "node", F.col("doc_id").cast("string").alias("doc_id"), *carried)
    proved = _proved([texts, *steps[1:]], finished, fanout, levels, ("doc_id", "node", *carried))
    doc_id = F.col("doc_id").cast(leaves.schema["doc_id"].dataType).alias("doc_id")
    return proved.select(doc_id, F.col("node").alias("leaf"), *carried, "subroot", "root", "lefts", "rights")


def folded(leaf: Column, lefts: Column, rights: Column) -> Column:
    """The root that ``leaf`` and a proof lead to."""
    steps = F.zip_with(lefts, rights, lambda left, right: F.struct(left.alias("left"), right.alias("right")))
    return F.aggregate(steps, leaf, lambda node, x: F.sha2(F.concat(x["left"], node, x["right"]), 256))


def proof_digest(lefts: Column, rights: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(lefts, rights, lambda left, right: F.concat(left, right)), ""), 256)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = proofs(leaves(docs, shown={"text": F.when(tampered, lowered).otherwise(F.col("text"))}), ("shown",))
    found = found.withColumn("folded_root", folded(F.col("shown"), F.col("lefts"), F.col("rights")))
    digest = proof_digest(F.col("lefts"), F.col("rights")).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", digest, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _leaf_sql(text: str) -> str:
    fields = [f if f != "text" else text for f in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen(({f})::varchar) || ':' || ({f})::varchar, '-')" for f in fields) + ")"


CRC32_SQL = """list_reduce(flatten(list_transform(string_split({0}::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda r, s: case when s >= 0 then xor(r, s) else xor(r >> 1, 3988292384 * (r & 1)) end, 4294967295)"""

OP11_SQL = f"""
with recursive crcs as (select *, xor({CRC32_SQL.format("doc_id")}, 4294967295) as crc from documents),
rows as (
  select doc_id, source, {_leaf_sql("text")} as leaf,
    {_leaf_sql("case when crc % 5 = 0 then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end")} as shown
  from crcs),
placed as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by source) as n from rows),
tree as (
  select source, 0 as level, pos, leaf as node, n from placed
  union all
  select source, any_value(level) + 1, pos // 16, sha256(string_agg(node, '' order by pos)), (any_value(n) + 15) // 16 from tree where n > 1 group by source, pos // 16),
subroots as (select source, node as subroot, row_number() over (order by source nulls first) - 1 as pos, count(*) over () as n from tree where n = 1),
top as (
  select 0 as level, pos, subroot as node, n from subroots
  union all
  select any_value(level) + 1, pos // 16, sha256(string_agg(node, '' order by pos)), (any_value(n) + 15) // 16 from top where n > 1 group by pos // 16),
beside as (
  select source, level, pos, coalesce(string_agg(node, '') over (w rows between unbounded preceding and 1 preceding), '') as l,
    coalesce(string_agg(node, '') over (w rows between 1 following and unbounded following), '') as r
  from tree where n > 1 window w as (partition by source, level, pos // 16 order by pos)),
top_beside as (
  select level, pos, coalesce(string_agg(node, '') over (w rows between unbounded preceding and 1 preceding), '') as l,
    coalesce(string_agg(node, '') over (w rows between 1 following and unbounded following), '') as r
  from top where n > 1 window w as (partition by level, pos // 16 order by pos)),
folds as (
  select doc_id, p.source, leaf, shown, 0 as level, p.pos, subroot, s.pos as top_at, '' as proof, shown as node, p.pos as id
  from placed p join subroots s on p.source is not distinct from s.source
  union all
  select doc_id, f.source, leaf, shown, f.level + 1, f.pos // 16, subroot, top_at, proof || l || r, sha256(l || node || r), id
  from folds f join beside b on f.source is not distinct from b.source and f.level = b.level and f.pos = b.pos),
done as (select *, -1 as step, top_at as up from folds qualify level = max(level) over (partition by source, id)),
tops as (
  select doc_id, source, leaf, subroot, proof, node, id, 0 as step, top_at as pos from done
  union all
  select doc_id, source, leaf, subroot, proof || l || r, sha256(l || node || r), id, step + 1, t.pos // 16 from tops t join top_beside b on t.step = b.level and t.pos = b.pos)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, node as folded_root, node = root as verified
from (select * from tops qualify step = max(step) over (partition by source, id)), (select node as root from top where n = 1)
"""
