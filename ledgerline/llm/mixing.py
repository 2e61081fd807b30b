"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words. Each of its documents is first taken in as many whole copies as the target holds of
the source; what is left is sampled without replacement, to a size fixed in words. A document's chance p is in proportion to
its size, as though words were drawn and brought their documents with them; those whose chance would be over 1 are certain and
leave less for the others. Documents are ranked by (U / (1 - U)) / (p / (1 - p)), U a random number drawn from the doc_id,
and are taken whole, in this order, as long as they fit. What is then missing up to the target goes to the next documents that
are no larger, in this order too, and at last to the one whose size is nearest to it, or to none if that is nearer still.

Ranks need no sort of a whole source: they are cut into ranges of some thousand documents, sums by range show in which one
the border lies, and only that range is ordered. Rows alike in source, id and size are one unit and share their fate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mix-1"
RANGE = 4096
BROADCAST_SOURCES = 50_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number over 0 and under 1 from the doc_id; the same in each run."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":" + seed)))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def plan(sized: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Per source of ``sized`` (source, size, u): its size, target, copies and where the order sample ends. A row a source."""
    one = Window.partitionBy()
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    turn = F.pmod(F.row_number().over(one.orderBy(F.asc_nulls_last("source"))) - 1, F.lit(len(weights)))
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long"))
    # Sources meet their cap in the order of cap by weight: what those before it leave tells if a source meets it too.
    order = one.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    sources = sources.withColumns(
        {
            "left": F.sum("source_size").over(one) - F.coalesce(F.sum("source_size").over(order), F.lit(0)) * most,
            "weights_left": F.sum("weight").over(one) - F.coalesce(F.sum("weight").over(order), F.lit(0)),
        }
    )
    share = F.col("left").cast("double") * F.col("weight") / F.col("weights_left")
    cap = F.col("source_size") * most
    sources = sources.withColumn("capped", share > cap)
    sources = sources.withColumns(
        {
            "left": F.min(F.when(~F.col("capped"), F.struct(-F.col("weights_left"), "left"))).over(one)["left"],
            "weights_left": F.max(F.when(~F.col("capped"), F.col("weights_left"))).over(one),
        }
    )
    sources = sources.withColumn("target", F.when(F.col("capped"), cap.cast("double")).otherwise(share))
    words = F.floor(F.col("target") + 0.5)
    copies = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumns({"copies": copies, "ranges": F.ceil(F.col("n") / RANGE)})
    sources = sources.withColumn("rest", (words - F.col("copies") * F.col("source_size")).cast("long"))
    return sources.select("source", "source_size", "target", "copies", "rest", "ranges")


def factors(sized: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    """Per source of ``sources`` that samples (rest > 0): source, factor; a document's chance is factor * size, at most 1.

    The chances, each times the size, add up to rest. Sizes over 1 / factor are certain. Work goes by the number of documents of each size.
    """
    sizes = _beside(sized.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")), sources, few).where("rest > 0")
    falling = Window.partitionBy("source").orderBy(F.desc("size"))
    words = F.col("n") * F.col("size")
    larger = F.coalesce(F.sum(words).over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    squares = F.sum(words.cast("decimal(38,0)") * F.col("size").cast("decimal(19,0)")).over(falling.rowsBetween(0, Window.unboundedFollowing))
    found = sizes.withColumn("factor", (F.col("rest") - larger).cast("double") / squares.cast("double")).where(F.col("factor") * F.col("size") <= 1)
    return found.groupBy("source").agg(F.max_by("factor", "size").alias("factor"))


def ranked(sized: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    """``sized`` with its source's columns; key, the Pareto rank first, null for what is not sampled; its place among the ranges."""
    chance = F.least(F.lit(1.0), F.col("factor") * F.col("size"))
    rank = F.when((F.col("rest") > 0) & (F.col("size") > 0), F.col("u") * (1 - chance) / ((1 - F.col("u")) * chance)).alias("rank")
    rows = _beside(sized, sources, few)
    rows = rows.withColumn("key", F.when((F.col("rest") > 0) & (F.col("size") > 0), F.struct(rank, "u", "doc_id", "size")))
    place = F.least(F.floor(F.col("key.rank") / (1 + F.col("key.rank")) * F.col("ranges")), F.col("ranges") - 1)
    return rows.withColumn("place", place)


def borders(rows: DataFrame, few: bool) -> DataFrame:
    """Per source that samples: source, edge, missing, at, until, last: ``sampled`` tells by them which of ``ranked`` rows are taken.

    Units fit up to ``edge``. Those of the same range (``at``) that are no larger than what is ``missing`` then go on up to ``until``, where
    they fit no more, null for never; ``last`` is the unit left there whose words are nearest to what is missing still, null if none helps.
    """
    sums = rows.where("key is not null").groupBy("source", "place").agg(F.sum("size").alias("size"), F.first("rest").alias("rest"))
    sums = sums.withColumn("upto", F.sum("size").over(Window.partitionBy("source").orderBy("place")))
    here = sums.where("upto > rest and upto - size <= rest").select("source", F.col("place").alias("at"), (F.col("rest") - F.col("upto") + F.col("size")).alias("need"))
    units = _beside(rows.select("source", "place", "key", "size"), here, few).where("place = at").groupBy("source", "at", "need", "key").agg(F.sum("size").alias("words"))
    by_key = Window.partitionBy("source").orderBy("key")
    units = common.materialised(units.withColumn("upto", F.sum("words").over(by_key)))
    short = lambda total, of: of - F.coalesce(F.max(F.when(F.col(total) <= of, F.col(total))), F.lit(0))
    over = lambda total, of: F.min(F.when(F.col(total) > of, F.col("key")))
    edges = units.groupBy("source", "at", "need").agg(over("upto", F.col("need")).alias("edge"), short("upto", F.col("need")).alias("missing")).drop("need")
    after = _beside(units.drop("at"), edges, few).where("key >= edge")
    fits = after.where("key.size <= missing").withColumn("filled", F.sum("words").over(by_key))
    fills = fits.groupBy("source", "missing").agg(over("filled", F.col("missing")).alias("until"), short("filled", F.col("missing")).alias("still")).drop("missing")
    left = _beside(after, fills, few).withColumn("still", F.coalesce("still", "missing")).where(~_fills())
    lasts = left.groupBy("source", "still").agg(F.min(F.struct(F.abs(F.col("words") - F.col("still")).alias("off"), "key")).alias("best"))
    lasts = lasts.select("source", F.when(F.col("best.off") < F.col("still"), F.col("best.key")).alias("last"))
    return _beside(_beside(edges, fills.drop("still"), few), lasts, few)


def _fills() -> Column:
    return (F.col("key.size") <= F.col("missing")) & F.coalesce(F.col("key") < F.col("until"), F.lit(True))


def sampled() -> Column:
    found = (F.col("key") < F.col("edge")) | (F.col("place") == F.col("at")) & _fills() | (F.col("key") == F.col("last"))
    return F.coalesce(found, F.lit(False))


def _beside(rows: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    """``rows`` with their source's columns. The sources, a row each, are sent to all tasks only if there are ``few``; else Spark joins."""
    named = sources.withColumnRenamed("source", "_source")
    return rows.join(F.broadcast(named) if few else named, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, most: int = MOST_COPIES, with_row: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken; with ``with_row`` also row, all its columns.

    ``taken`` is a multiple of ``size``. A null text has size 0; null is a source of its own, the last. Sources without words have
    target 0. Rows alike in source, id and size are taken alike; ties of the draw go by doc_id. An empty table gives no rows.
    """
    base = docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"), docs[text_col].alias("text"), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    base = base.select("doc_id", "source", n_words(F.col("text")).alias("size"), draw(F.col("doc_id")).alias("u"), *["row"] * with_row)
    sized = common.materialised(base.drop("row"))  # narrow: the texts are not read again for the sums
    sources = common.materialised(plan(sized, weights, most))
    few = sources.count() <= BROADCAST_SOURCES
    sources = common.materialised(_beside(sources, factors(sized, sources, few), few))
    ends = common.materialised(_beside(sources, borders(ranked(sized, sources, few), few), few))
    rows = ranked(base if with_row else sized, ends, few)
    taken = (F.col("copies") + sampled().cast("int")) * F.col("size")
    return rows.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), *["row"] * with_row)


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The mix itself: the rows of ``docs``, all columns and whole texts, as often as taken.

    Documents of which nothing is taken are left out, so those with null or blank texts too; an empty table gives no rows; no
    name of a column can clash. Rows alike in source, id and size come as often as each other.
    """
    taken = mix(docs, id_col, text_col, source_col, weights, most, with_row=True).where("taken > 0")
    times = F.array_repeat(F.lit(0), F.floor(F.col("taken") / F.col("size")).cast("int"))
    return taken.select("row", F.explode(times)).select(*(F.col("row")[c].alias(c) for c in docs.columns))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents"))


OP6_SQL = """
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as size,
    (cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':mix-1'), 1, 12)) as bigint) + 0.5::double) / 281474976710656::double as u
  from documents),
sources as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from sources),
before as (
  select *, sum(source_size) over () - 3 * coalesce(sum(source_size) over w, 0) as rest_words, sum(weight) over () - coalesce(sum(weight) over w, 0) as rest_weights
  from weighed window w as (order by source_size::double / weight, source nulls last rows between unbounded preceding and 1 preceding)),
caps as (select *, rest_words::double * weight / rest_weights > 3 * source_size as capped from before),
shares as (
  select source, source_size, case when capped then (3 * source_size)::double else
    (select rest_words::double from caps where not capped order by rest_weights desc limit 1) * weight / (select max(rest_weights) from caps where not capped) end as target
  from caps),
split as (
  select *, case when source_size > 0 then floor(floor(target + 0.5) / source_size)::bigint else 0 end as copies from shares),
rests as (
  select *, floor(target + 0.5)::bigint - copies * source_size as rest, (select ceil(count(*) / 4096::double) from sized d where d.source is not distinct from s.source) as ranges
  from split s),
sizes as (select source, size, count(*) as n from sized where size > 0 group by all),
tails as (
  select z.source, size, rest, coalesce(sum(n * size) over (w rows between unbounded preceding and 1 preceding), 0) as larger,
    sum(n::hugeint * size * size) over (w rows between current row and unbounded following) as squares
  from sizes z join rests r on z.source is not distinct from r.source where rest > 0 window w as (partition by z.source order by size desc)),
factors as (
  select source, arg_max((rest - larger)::double / squares::double, size) as factor from tails where (rest - larger)::double / squares::double * size <= 1 group by source),
chances as (
  select doc_id, d.source, size, u, rest, ranges, least(1::double, factor * size) as p
  from sized d join rests r on d.source is not distinct from r.source join factors f on d.source is not distinct from f.source where size > 0),
ranks as (select *, u * (1 - p) / ((1 - u) * p) as rank from chances),
units as (
  select source, doc_id, size, u, rank, rest, least(floor(rank / (1 + rank) * ranges), ranges - 1) as place, sum(size) as words from ranks group by all),
ordered as (select *, sum(words) over w as upto, row_number() over w as k from units window w as (partition by source order by rank, u, doc_id nulls first, size)),
edges as (select source, min(k) as edge, arg_min(place, k) as range_at, arg_min(rest - upto + words, k) as missing from ordered where upto > rest group by source),
after as (
  select o.source, o.doc_id, o.size, k, words, missing from ordered o join edges e on o.source is not distinct from e.source where k >= edge and place = range_at),
fits as (select *, sum(words) over (partition by source order by k) as filled from after where size <= missing),
fills as (select source, doc_id, size, words, k from fits where filled <= missing),
still as (select e.source, missing - coalesce((select sum(words) from fills f where f.source is not distinct from e.source), 0) as still from edges e),
near as (
  select a.source, doc_id, size, k, abs(words - still) as off, still from after a join still s on a.source is not distinct from s.source
  where k not in (select k from fills f where f.source is not distinct from a.source)),
lasts as (select source, arg_min(k, (off, k)) as k from near where off < still group by source),
sampled as (
  select o.source, doc_id, size from ordered o join edges e on o.source is not distinct from e.source where k < edge
  union all select source, doc_id, size from fills
  union all select n.source, doc_id, size from near n join lasts l on n.source is not distinct from l.source and n.k = l.k)
select d.doc_id, d.size::bigint as size, source_size, target, ((copies + (p.size is not null)::int) * d.size)::bigint as taken
from sized d join rests r on d.source is not distinct from r.source
left join sampled p on d.source is not distinct from p.source and d.doc_id is not distinct from p.doc_id and d.size = p.size
"""
