"""Filters, projections, sorts and pages over the registry view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import lists, text
from ledgerline.operators import postings, search, sequence
from ledgerline.sources import tables
from ledgerline.sources.tables import materialised

from .base import ACQ_SQL, PACKED_SQL, Tables, acquisition_heads, acquisitions, packed_suppliers, query, spread
from .scalars import cases, cases_sql

C, L = F.col, F.lit

SUPPLIERS = "dims as (select 'S' || s_suppkey as key, s_name as name, s_acctbal as owner from supplier)"
ITEMS = """items as (
  select order_key, v, min(i) as pos from (select order_key, unnest(string_split(cell, ';')) as v, generate_subscripts(string_split(cell, ';'), 1) as i from packed) group by order_key, v)"""
LOOKED_UP = f"""{ITEMS}, hits as (
  select order_key, string_agg(name, ';' order by pos) as names, arg_min(owner, pos) as first_owner from items join dims on v = key group by order_key)"""


def suppliers(t: Tables) -> DataFrame:
    """Every ninth is missing, so that some keys dangle."""
    return t.supplier.where("s_suppkey % 9 <> 0").select(F.concat(L("S"), C("s_suppkey").cast("string")).alias("key"), C("s_name").alias("name"), C("s_acctbal").alias("owner"))


DIMS_SQL = SUPPLIERS.replace("from supplier", "from supplier where s_suppkey % 9 <> 0")


def looked_up(t: Tables) -> DataFrame:
    return search.multi_lookup(acquisitions(t), "o_orderkey", "cell", suppliers(t), "key", ["name"], ["owner"])


LOOKED_SQL = f"{ACQ_SQL}, {DIMS_SQL}, {LOOKED_UP}, rich as (select acq.*, coalesce(names, '') as names, first_owner from acq left join hits on o_orderkey = order_key)"
BLOB_SQL = "lower(concat_ws(' ', acq_id, day, instrument, cell, names))"


@query(f"with {LOOKED_SQL} select o_orderkey, names, first_owner from rich")
def multi_lookup_join(t: Tables) -> DataFrame:
    return looked_up(t).select("o_orderkey", "names", "first_owner")


@query("select o_orderkey, lower(concat_ws(' ', case when o_orderkey % 4 = 0 then '' else o_orderstatus end, c_name, o_orderpriority)) as blob from orders join customer on o_custkey = c_custkey")
def build_search_blob(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, C("o_custkey") == C("c_custkey")).withColumn("status", F.when(C("o_orderkey") % 4 != 0, C("o_orderstatus")))
    return rows.select("o_orderkey", search.search_blob("status", "c_name", "o_orderpriority").alias("blob"))


@query(f"with {ACQ_SQL} select o_orderkey, acq_id from acq where contains(lower(concat_ws(' ', acq_id, day, instrument, cell)), '-hig-10')")
def search_freetext(t: Tables) -> DataFrame:
    rows = acquisitions(t)
    rows = rows.where(search.matches(search.Filters(text="-HIG-10"), search.search_blob("acq_id", "day", "instrument", "cell"), C("day")))
    return rows.select("o_orderkey", "acq_id")


@query(f"with {ACQ_SQL} select o_orderkey, acq_id from acq where contains(lower(concat_ws(' ', acq_id, day, instrument)), '-hig-10')")
def search_postings(t: Tables) -> DataFrame:
    """The search again, over a registry and a table of trigrams that both grew by appends."""
    base = tables.scratch(t.spark, "postings")
    rows = spread(acquisition_heads(t).select("o_orderkey", "acq_id", search.search_blob("acq_id", "day", "instrument").alias("blob")))
    for part in (C("o_orderkey") % 3 > 0, C("o_orderkey") % 3 == 0):
        rows.where(part).sort("o_orderkey").write.mode("append").parquet(f"{base}/registry")
        postings.add(rows.where(part), "o_orderkey", "blob", f"{base}/grams")
    registry = t.spark.read.schema(rows.schema).parquet(f"{base}/registry")
    return postings.searched(registry, "o_orderkey", "blob", f"{base}/grams", "-HIG-10").select("o_orderkey", "acq_id")


@query("select o_orderkey, o_orderpriority from orders where lower(o_orderpriority) = '1-urgent'")
def filter_eq_ci(t: Tables) -> DataFrame:
    return t.orders.where(search.matches(search.Filters(equal=(("o_orderpriority", "1-Urgent"),)), L(""), L(""))).select("o_orderkey", "o_orderpriority")


@query("select c_custkey, c_name from customer where contains(lower(c_name), 'er#00000012')")
def filter_contains_ci(t: Tables) -> DataFrame:
    return t.customer.where(search.matches(search.Filters(contain=(("c_name", "ER#00000012"),)), L(""), L(""))).select("c_custkey", "c_name")


@query("select p_partkey from part where contains(lower(p_name), 'red') or contains(lower(p_brand), 'red') or contains(lower(p_type), 'red')")
def filter_or_two_cols(t: Tables) -> DataFrame:
    return t.part.where(search.matches(search.Filters(either=((("p_name", "p_brand", "p_type"), "Red"),)), L(""), L(""))).select("p_partkey")


@query(f"with {PACKED_SQL} select order_key from packed where len(list_filter(string_split(cell, ';'), lambda x: contains(x, 'S4'))) > 0")
def filter_list_any(t: Tables) -> DataFrame:
    return packed_suppliers(t).where(lists.any_contains(lists.split_packed(C("cell")), "s4")).select("order_key")


@query(f"with {ACQ_SQL} select o_orderkey, day from acq where day = '' or day between '1997-02-01' and '1997-03-31'")
def filter_daterange_blank_passes(t: Tables) -> DataFrame:
    return acquisitions(t).where(search.in_range(C("day"), "1997-02-01", "1997-03-31")).select("o_orderkey", "day")


@query(f"with {ACQ_SQL} select o_orderkey, day from acq where day <> '' and day >= '1999-02-01'")
def filter_daterange_blank_fails(t: Tables) -> DataFrame:
    return acquisitions(t).where(search.in_range(C("day"), "1999-02-01", None, blank_passes=False)).select("o_orderkey", "day")


@query(f"with {PACKED_SQL}, marked as (select order_key, list_contains(string_split(cell, ';'), 'S7') as own from packed) select order_key, (select count(*) from marked where own) as n_excluded from marked where not own")
def exclude_member_with_count(t: Tables) -> DataFrame:
    kept, n = search.counted(packed_suppliers(t), lists.has_packed(C("cell"), "S7"))
    return kept.crossJoin(F.broadcast(n)).select("order_key", "n_excluded")  # one row


COMBINED = search.Filters(text="acq-", equal=(("instrument", "1-urgent"),), contain=(("status", "o"),), lists=((("cell", "names"), "s2"),), since="1996-01-01", until="2000-12-31")
COMBINED_SQL = f"""contains({BLOB_SQL}, 'acq-') and lower(instrument) = '1-urgent' and contains(lower(status), 'o')
  and len(list_filter(list_concat(string_split(cell, ';'), string_split(names, ';')), lambda x: contains(lower(x), 's2'))) > 0
  and (day = '' or day between '1996-01-01' and '2000-12-31')"""


def combined(t: Tables) -> DataFrame:
    """What an acquisition itself tells is asked first; only what passes gets its cell packed and its names looked up."""
    early, late = search.split(COMBINED, ("acq_id", "day", "instrument", "status"))
    some = acquisitions(t, lambda rows: rows.where(search.matches(early, L(""), C("day"))))
    rich = search.multi_lookup(some, "o_orderkey", "cell", suppliers(t), "key", ["name"], ["owner"])
    return rich.where(search.matches(late, search.search_blob("acq_id", "day", "instrument", "cell", "names"), C("day")))


@query(f"with {LOOKED_SQL} select o_orderkey, acq_id, day, instrument, names, first_owner, project_key from rich where {COMBINED_SQL} order by day desc, o_orderkey limit 200")
def search_combined(t: Tables) -> DataFrame:
    return search.page(combined(t), "day", "o_orderkey").select("o_orderkey", "acq_id", "day", "instrument", "names", "first_owner", "project_key")


@query(f"with {LOOKED_SQL}, found as (select * from rich where {COMBINED_SQL}) select o_orderkey, acq_id, day, (select count(*) from found) as total from found order by day desc, o_orderkey limit 20 offset 20")
def search_page(t: Tables) -> DataFrame:
    """The second page of twenty, each row with the number of all matches. The matches are found once, for page and count; the count is one row."""
    rows = materialised(combined(t).select("o_orderkey", "acq_id", "day"), "matches")
    return search.page(rows, "day", "o_orderkey", 20, 20).crossJoin(F.broadcast(rows.agg(F.count("*").alias("total"))))


@query("select p_partkey from part where string_split(p_name, ' ')[1] = 'red' and string_split(p_name, ' ')[2] = 'bolt'")
def filter_parsed_keys(t: Tables) -> DataFrame:
    keys = F.map_from_arrays(F.array(L("colour"), L("thing")), F.slice(F.split("p_name", " "), 1, 2))
    return t.part.where(F.size(F.split("p_name", " ")) >= 2).where(keys["colour"].eqNullSafe("red") & keys["thing"].eqNullSafe("bolt")).select("p_partkey")


@query("select c_custkey from customer where c_mktsegment <> 'MACHINERY' and (contains(lower(c_name), '12') or contains(c_nationkey::varchar, '12') or contains(lower(c_mktsegment), '12'))")
def filter_hide_closed_any_col(t: Tables) -> DataFrame:
    shown = F.array(C("c_name"), C("c_nationkey").cast("string"), C("c_mktsegment"))
    return t.customer.where((F.lower("c_mktsegment") != "machinery") & lists.any_contains(shown, "12")).select("c_custkey")


@query("select o_orderkey from orders where o_orderstatus = 'P'")
def filter_pending(t: Tables) -> DataFrame:
    return t.orders.where(F.lower(text.strip(F.concat(L(" "), "o_orderstatus"))) == "p").select("o_orderkey")


@query("select o_orderkey from orders where o_orderpriority = '2-HIGH' and o_orderkey % 3 < 2 and o_orderkey % 5 > 0")
def filter_placeholder(t: Tables) -> DataFrame:
    rows = t.orders.withColumns({"file_count": cases(C("o_orderkey"), "0", "", "7"), "path": F.when(C("o_orderkey") % 5 == 0, "").otherwise("/raw/x")})
    return rows.where("o_orderpriority = '2-HIGH' and file_count in ('0', '') and path <> ''").select("o_orderkey")


@query("select p_partkey, case when k in ('organism', 'tissue') then p_name end as subject, case when k in ('organism', 'tissue', 'cells') then p_brand end as condition from (select *, " + cases_sql("p_size", "'organism'", "'tissue'", "'cells'", "'phantom'") + " as k from part)")
def gate_blocks(t: Tables) -> DataFrame:
    rows = t.part.withColumn("k", cases(C("p_size"), "organism", "tissue", "cells", "phantom"))
    subject = F.when(C("k").isin("organism", "tissue"), F.struct("p_name"))
    condition = F.when(C("k").isin("organism", "tissue", "cells"), F.struct("p_brand"))
    return rows.select("p_partkey", subject["p_name"].alias("subject"), condition["p_brand"].alias("condition"))


@query("select p_partkey, " + cases_sql("p_partkey", "''", "'/raw/' || p_partkey || '/' || p_name", "'/raw/' || p_partkey", "'/raw/' || p_partkey || '/.data'") + " as path from part")
def resolve_primary_case(t: Tables) -> DataFrame:
    folder = cases(C("p_partkey"), L(""), *[F.concat(L("/raw/"), C("p_partkey").cast("string"))] * 3)
    kind, name = cases(C("p_partkey"), "file", "file", "folder", "series"), C("p_name")
    path = F.when(folder == "", "").when(kind == "file", F.concat_ws("/", folder, name)).when(kind == "folder", folder).otherwise(F.concat_ws("/", folder, L(".data")))
    return t.part.select("p_partkey", path.alias("path"))


GAPS = ["subject block missing", "condition block missing", "subject pending", "control unknown"]
GAP_SQL = """gaps as (
  select event_id, unnest(list_filter([
    case when event_id % 5 = 0 then 'subject block missing' end, case when event_id % 7 = 0 then 'condition block missing' end,
    case when event_id % 5 > 0 and value < 5 then 'subject pending' end, case when event_id % 7 > 0 and event_id % 3 = 0 then 'control unknown' end], lambda x: x is not null)) as gap
  from events where event_type <> 'view')"""


def gaps(t: Tables) -> DataFrame:
    """One row for each gap of an event's document; kinds of event that need no blocks have none."""
    subject = F.when(C("event_id") % 5 != 0, F.struct(F.when(C("value") < 5, "pending-db").otherwise("db").alias("source")))
    condition = F.when(C("event_id") % 7 != 0, F.struct(F.when(C("event_id") % 3 == 0, None).otherwise(L(True)).alias("is_control")))
    rows = t.events.where("event_type <> 'view'").select("event_id", subject.alias("subject"), condition.alias("condition"))
    found = F.array(
        F.when(C("subject").isNull(), GAPS[0]),
        F.when(C("condition").isNull(), GAPS[1]),
        F.when(C("subject.source") == "pending-db", GAPS[2]),
        F.when(C("condition").isNotNull() & C("condition.is_control").isNull(), GAPS[3]),
    )
    return rows.select("event_id", F.explode(F.array_compact(found)).alias("gap"))


@query(f"with {GAP_SQL} select * from gaps")
def gaps_explode(t: Tables) -> DataFrame:
    return gaps(t)


@query("select event_id, event_id % 3 < 2 as unset, event_id % 3 = 0 as null_given from events")
def json_unset_predicate(t: Tables) -> DataFrame:
    """A block without a label whose flag is null or absent; a JSON null and an absent key are told apart."""
    doc = F.parse_json(cases(C("event_id"), '{"whole":null,"region":{}}', "{}", '{"whole":true}'))
    flag = F.variant_get(doc, "$.whole", "variant")
    unset = (F.variant_get(doc, "$.region.label", "string").isNull()) & F.variant_get(doc, "$.whole", "boolean").isNull()
    return t.events.select("event_id", unset.alias("unset"), F.coalesce(F.is_variant_null(flag), L(False)).alias("null_given"))


@query("select c_custkey, " + cases_sql("c_custkey", "'missing'", "'unset'", "lower(c_mktsegment)") + " as sample_type, case when c_custkey % 4 = 0 then 'UNKNOWN' else upper(c_name) end as instrument, case when c_custkey % 3 = 0 then 'missing document' when c_custkey % 3 = 1 then 'untyped' else 'typed' end as category from customer")
def classify_category(t: Tables) -> DataFrame:
    given = cases(C("c_custkey"), L(None), L(" "), F.concat(C("c_mktsegment"), L(" ")))
    kind = F.when(given.isNull(), "missing").otherwise(F.coalesce(F.nullif(F.lower(text.strip(given)), L("")), L("unset")))
    instrument = F.coalesce(F.nullif(F.upper(text.strip(F.when(C("c_custkey") % 4 == 0, "").otherwise(C("c_name")))), L("")), L("UNKNOWN"))
    category = F.when(kind == "missing", "missing document").when(kind == "unset", "untyped").otherwise("typed")
    return t.customer.select("c_custkey", kind.alias("sample_type"), instrument.alias("instrument"), category.alias("category"))


@query("select l_orderkey, bool_or(l_returnflag = 'A') and bool_or(l_returnflag = 'R') as complete from lineitem group by l_orderkey")
def folder_has_all(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg((F.bool_or(C("l_returnflag") == "A") & F.bool_or(C("l_returnflag") == "R")).alias("complete"))


@query("select c_custkey, case when c_custkey % 2 = 0 then c_name else 'unknown' end as name, 'unknown' as sex, case when c_custkey % 3 = 0 then c_mktsegment else '' end as strain, 'unknown' as source from customer")
def overlay_template(t: Tables) -> DataFrame:
    """A partial record laid over a template of defaults: nulls and blanks never win."""
    partial = {"name": F.when(C("c_custkey") % 2 == 0, C("c_name")), "sex": L(" "), "strain": F.when(C("c_custkey") % 3 == 0, C("c_mktsegment"))}
    default = {"name": "unknown", "sex": "unknown", "strain": "", "source": "unknown"}
    laid = F.struct(*(F.coalesce(F.nullif(text.strip(partial.get(k, L(None).cast("string"))), L("")), L(v)).alias(k) for k, v in default.items()))
    return t.customer.select("c_custkey", laid.alias("s")).select("c_custkey", "s.*")


@query("select p_partkey, code from (select p_partkey, unnest(case p_partkey % 3 when 0 then [p_size, p_size + 1] when 1 then [p_size] else [null] end)::bigint as code from part)")
def lookup_pairs(t: Tables) -> DataFrame:
    """Packed codes where there are any, else the single one; what is no number drops; a part without codes stays with none."""
    n = C("p_size").cast("string")
    packed, single = cases(C("p_partkey"), F.concat(n, L(";x;m"), (C("p_size") + 1).cast("string")), L(""), L("")), cases(C("p_partkey"), L("9"), n, L("none"))
    raw = F.when(F.size(lists.split_packed(packed)) > 0, lists.split_packed(packed)).otherwise(F.array(single))
    codes = F.filter(F.transform(raw, lambda x: text.short_code(x)["code"]), lambda x: x.isNotNull())
    return t.part.select("p_partkey", F.explode_outer(codes).alias("code"))


@query("select p_partkey, case when p_partkey % 3 = 0 then p_type when p_partkey % 3 = 1 then p_brand end as region, case when p_partkey % 3 = 0 then 'operator' when p_partkey % 3 = 1 then 'derived' else 'unknown' end as source, case when p_partkey % 3 = 2 then 'no region' else '' end as warnings from part")
def resolve_blocks(t: Tables) -> DataFrame:
    given, derived = F.when(C("p_partkey") % 3 == 0, C("p_type")), F.when(C("p_partkey") % 3 == 1, C("p_brand"))
    source = F.when(given.isNotNull(), "operator").when(derived.isNotNull(), "derived").otherwise("unknown")
    warnings = F.array_compact(F.array(F.when(F.coalesce(given, derived).isNull(), "no region")))
    return t.part.select("p_partkey", F.coalesce(given, derived).alias("region"), source.alias("source"), F.array_join(warnings, ";").alias("warnings"))


@query("select event_id, coalesce(props->>'$.k', '') as k, '' as absent, event_type || '/' || user_id as label from events")
def nested_projection(t: Tables) -> DataFrame:
    doc = F.parse_json("props")
    study = F.struct(F.coalesce(F.variant_get(doc, "$.k", "string"), L("")).alias("k"), F.coalesce(F.try_variant_get(doc, "$.x[0].y", "string"), L("")).alias("absent"))
    who = F.struct(F.concat_ws("/", "event_type", C("user_id").cast("string")).alias("label"))
    return t.events.select("event_id", F.struct(study.alias("study"), who.alias("who")).alias("s")).select("event_id", "s.study.*", "s.who.*")


@query("select l_orderkey, count(*) as n_signals, sum(l_partkey)::bigint as key_sum from lineitem group by l_orderkey")
def flatten_signals(t: Tables) -> DataFrame:
    """Lines nested by order and flag, then flattened again to one list of signals."""
    nested = t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(F.collect_list("l_partkey").alias("keys")).groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "keys"))).alias("m"))
    signals = F.flatten(F.map_values("m"))
    return nested.select("l_orderkey", F.size(signals).cast("long").alias("n_signals"), F.aggregate(signals, L(0).cast("long"), lambda a, x: a + x).alias("key_sum"))


# Sorts and limits


@query(f"with {ACQ_SQL} select o_orderkey, day, row_number() over (order by day desc, o_orderkey) as place from acq")
def sort_newest_first(t: Tables) -> DataFrame:
    return sequence.placed(acquisitions(t).select("o_orderkey", "day"), C("day").desc(), C("o_orderkey"))


@query("select c_custkey, c_acctbal, (select count(*) from customer) as total from customer order by c_acctbal desc, c_custkey limit 800")
def sort_cap(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_acctbal")
    return rows.orderBy(C("c_acctbal").desc(), "c_custkey").limit(800).crossJoin(F.broadcast(rows.agg(F.count("*").alias("total"))))


@query("select o_orderkey, (select count(*) from orders where o_orderstatus = 'P') - 50 as more from orders where o_orderstatus = 'P' order by o_orderkey limit 50")
def head_plus_rest(t: Tables) -> DataFrame:
    rows = t.orders.where("o_orderstatus = 'P'").select("o_orderkey")
    rest = rows.agg(F.greatest(F.count("*") - 50, L(0)).alias("more"))
    return rows.orderBy("o_orderkey").limit(50).crossJoin(F.broadcast(rest))


@query("select p_partkey, row_number() over (order by p_type, p_size desc, p_partkey) as place from part")
def multi_key_sort(t: Tables) -> DataFrame:
    return sequence.placed(t.part.select("p_type", "p_size", "p_partkey"), C("p_type"), C("p_size").desc(), C("p_partkey")).select("p_partkey", "place")


@query("select c_custkey, c_name, row_number() over (order by c_custkey desc) as place from customer")
def sort_id_desc(t: Tables) -> DataFrame:
    return sequence.placed(t.customer.select("c_custkey", "c_name"), C("c_custkey").desc())


@query("select p_partkey, idx, row_number() over (order by try_cast(idx as int) nulls last, idx, p_partkey) as place from (select p_partkey, case when p_partkey % 10 = 0 then 'x' || p_size else p_size::varchar end as idx from part)")
def natural_sort(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.when(C("p_partkey") % 10 == 0, F.concat(L("x"), C("p_size").cast("string"))).otherwise(C("p_size").cast("string")).alias("idx"))
    return sequence.placed(rows, C("idx").try_cast("int").asc_nulls_last(), C("idx"), C("p_partkey"))


@query("select l_orderkey, l_partkey, l_suppkey, l_extendedprice from lineitem qualify row_number() over (partition by l_orderkey order by l_extendedprice desc, l_partkey, l_suppkey) <= 2")
def topn_per_group(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(C("l_extendedprice").desc(), "l_partkey", "l_suppkey"))
    return t.lineitem.withColumn("place", place).where("place <= 2").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")

