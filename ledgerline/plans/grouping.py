"""Aggregations and order-dependent groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import lists, paths, text, values
from ledgerline.operators import grouping, sequence
from ledgerline.sources import tables

from .base import PACKED_SQL, Tables, packed_suppliers, query
from .scalars import cases, cases_sql
from .searching import GAP_SQL, GAPS, gaps

C, L = F.col, F.lit
LINE = ["l_linenumber", "l_suppkey", "l_partkey", "l_quantity"]
LINE_SQL = "l_linenumber, l_suppkey, l_partkey, l_quantity"


@query(f"with {PACKED_SQL}, items as (select distinct order_key, unnest(string_split(cell, ';')) as item from packed) select item, count(*) as n from items group by item")
def group_by_list_element(t: Tables) -> DataFrame:
    return grouping.by_item(packed_suppliers(t), lists.split_packed(C("cell")), "item").groupBy("item").agg(F.count("*").alias("n"))


@query(f"with {GAP_SQL} select gap, count(*) as n, count(distinct event_id) as n_events, list_position({GAPS!r}, gap)::int as place from gaps group by gap")
def gap_counts(t: Tables) -> DataFrame:
    place = F.array_position(F.array(*map(L, GAPS)), C("gap")).cast("int")
    return gaps(t).groupBy("gap").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("n_events")).withColumn("place", place).orderBy("place", "gap")


@query("select o_orderpriority, count(*) as n, count(*) filter (o_orderstatus = 'F') as n_f, count(*) filter (o_orderstatus = 'O') as n_o, count(*) filter (o_orderstatus = 'P') as n_p, count(*) filter (o_totalprice > 200000) as n_large from orders group by o_orderpriority")
def inventory_crosstab(t: Tables) -> DataFrame:
    by_status = [F.count_if(C("o_orderstatus") == s).alias(f"n_{s.lower()}") for s in "FOP"]
    return t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"), *by_status, F.count_if(C("o_totalprice") > 200000).alias("n_large"))


@query("select flag, count(*) as n from (select unnest(case when p_size % 3 = 0 then [p_brand, 'size'] else [p_brand] end) as flag from part) group by flag")
def flag_histogram(t: Tables) -> DataFrame:
    """Flags packed by commas; what follows a colon is left out."""
    cell = F.concat("p_brand", L(":"), C("p_size").cast("string"), F.when(C("p_size") % 3 == 0, F.concat(L(",size:"), C("p_size").cast("string"))).otherwise(""))
    rows = t.part.select("p_partkey", F.explode(lists.split_packed(cell, ",")).alias("item")).select("p_partkey", F.split_part("item", L(":"), L(1)).alias("flag"))
    return grouping.histogram(rows, "flag", "p_partkey").orderBy(C("n").desc(), "first").select("flag", "n")


@query("select year(l_shipdate)::int as year, l_returnflag, count(*) as n, count(*) filter (l_discount = 0) as n_clean, count(*) filter (l_tax > 0.05) as n_taxed from lineitem group by all")
def multi_measure_group(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.year("l_shipdate").alias("year"), "l_returnflag").agg(F.count("*").alias("n"), F.count_if(C("l_discount") == 0).alias("n_clean"), F.count_if(C("l_tax") > 0.05).alias("n_taxed"))


@query("select count(*) as n, sum(l_quantity::bigint)::bigint as units, count(*) filter (l_quantity > 25) as n_many, round(100.0::double * count(*) filter (l_returnflag = 'R') / count(*), 2) as share from lineitem")
def global_summary(t: Tables) -> DataFrame:
    share = F.round(F.count_if(C("l_returnflag") == "R") * 100.0 / F.count("*"), 2)
    return t.lineitem.agg(F.count("*").alias("n"), F.sum(C("l_quantity").cast("long")).alias("units"), F.count_if(C("l_quantity") > 25).alias("n_many"), share.alias("share"))


@query(f"select l_orderkey, count(*) as n_files, sum(l_quantity::bigint)::bigint as total, arg_min(l_partkey, ({LINE_SQL})) as first_part, arg_min(l_returnflag, ({LINE_SQL}, l_returnflag)) as first_flag from lineitem group by l_orderkey".replace("(l_linenumber", "row(l_linenumber"))
def fanin_group(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(
        F.count("*").alias("n_files"), F.sum(C("l_quantity").cast("long")).alias("total"), F.min_by("l_partkey", F.struct(*LINE)).alias("first_part"), F.min_by("l_returnflag", F.struct(*LINE, "l_returnflag")).alias("first_flag")
    )


@query("select arg_min(source || '/' || lang, doc_id) as shown, count(*) as n, string_agg(doc_id::varchar, ';' order by doc_id) as members from documents where text <> '' group by lower(source), sha256(lower(text)) having count(*) > 1")
def collision_groups(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", F.concat_ws("/", "source", "lang").alias("shown_as"), "source", F.sha2(F.lower("text"), 256).alias("digest"), C("doc_id").alias("ord"))
    return grouping.collisions(rows, [F.lower("source"), C("digest")], "doc_id", "shown_as", "ord")


@query("select page_id, case when count(*) over (partition by lower(leaf)) > 1 then leaf || '_' || page_id else leaf end as name from (select page_id, regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '([^/]*)/?$', 1) as leaf from pages)")
def collision_disambiguate(t: Tables) -> DataFrame:
    rows = t.pages.select("page_id", F.regexp_extract(F.regexp_replace("url", "[?#].*$", ""), "([^/]*)/?$", 1).alias("leaf"))
    rows = sequence.with_summary(rows, F.lower("leaf"), n=F.count("*"))
    return rows.select("page_id", F.when(C("n") > 1, F.concat_ws("_", "leaf", C("page_id").cast("string"))).otherwise(C("leaf")).alias("name"))


@query("select 'Customer' as prefix, max(c_custkey) + 1 as next, printf('%04d', max(c_custkey) + 1) as padded from customer where c_custkey % 7 > 0")
def next_id_max_suffix(t: Tables) -> DataFrame:
    name = F.when(C("c_custkey") % 7 == 0, "Customer#none").otherwise(C("c_name"))
    return grouping.next_number(t.customer.select(name.alias("id")), "id", "#").withColumn("padded", F.format_string("%04d", "next"))


@query("select user_id, arg_max(event_type, row(n, -first)) as mode from (select user_id, event_type, count(*) as n, min(event_id) as first from (select *, row_number() over (partition by user_id order by event_id) as k from events) where k <= 20 group by all) group by user_id")
def mode_first_tie(t: Tables) -> DataFrame:
    return grouping.mode_first(t.events, "user_id", "event_type", "event_id", 20)


@query("select distinct trim(o_orderpriority) as facet from orders where o_orderstatus = 'P'")
def distinct_facet(t: Tables) -> DataFrame:
    return t.orders.where("o_orderstatus = 'P'").select(F.trim("o_orderpriority").alias("facet")).where("facet <> ''").distinct().orderBy("facet")


@query("with counted as (select p_brand, count(*) as n, min(p_partkey) as first from part group by p_brand), placed as (select *, row_number() over (order by n desc, first) as k from counted) select p_brand, n from placed where k <= 5 union all select '(rest)', sum(n)::bigint from placed where k > 5 having sum(n) > 0")
def top5_plus_rest(t: Tables) -> DataFrame:
    return grouping.top_and_rest(t.part, "p_brand", "p_partkey", 5)


@query("select source, count(*) as n_files, round_even(sum(n_chars)::double / 1e6, 1) as mb from documents group by source")
def inventory_mb(t: Tables) -> DataFrame:
    return t.documents.groupBy("source").agg(F.count("*").alias("n_files"), values.megabytes(F.sum("n_chars")).alias("mb"))


@query("select depth, count(*) as n, min(url) as sample from (select url, len(list_filter(string_split(url, '/'), lambda x: x <> ''))::int as depth from pages) group by depth")
def path_depths(t: Tables) -> DataFrame:
    return t.pages.select("url", F.size(paths.parts(C("url"))).alias("depth")).groupBy("depth").agg(F.count("*").alias("n"), F.min("url").alias("sample"))


@query("select l_suppkey, string_agg(l_orderkey::varchar, ',' order by l_orderkey) as orders from (select distinct l_suppkey, l_orderkey from lineitem where l_returnflag = 'R') group by l_suppkey")
def group_sorted_list(t: Tables) -> DataFrame:
    rows = t.lineitem.where("l_returnflag = 'R'").groupBy("l_suppkey").agg(F.array_sort(F.collect_set("l_orderkey")).alias("o"))
    return rows.select("l_suppkey", F.array_join(C("o").cast("array<string>"), ",").alias("orders"))


@query("select key, min(event_id) as first, count(*) as n from (select event_id, unnest(case when event_id % 4 = 0 then ['k', 'extra'] when event_id % 4 = 1 then ['late', 'k'] else ['k'] end) as key from events) group by key")
def dynamic_keys(t: Tables) -> DataFrame:
    """The keys that documents have, with where each is first seen."""
    doc = cases(C("event_id"), '{"k":1,"extra":2}', '{"late":1,"k":2}', C("props"), C("props"))
    return t.events.select("event_id", F.explode(F.json_object_keys(doc)).alias("key")).groupBy("key").agg(F.min("event_id").alias("first"), F.count("*").alias("n"))


@query(f"select l_orderkey, coalesce(string_agg(case when l_suppkey % 5 > 0 then 'S' || l_suppkey end, ';' order by {LINE_SQL}), '') as cell from lineitem group by l_orderkey")
def pack_list(t: Tables) -> DataFrame:
    name = F.when(C("l_suppkey") % 5 > 0, F.concat(L("S"), C("l_suppkey").cast("string"))).otherwise("")
    nested = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*LINE, name.alias("name")))).alias("s"))
    return nested.select("l_orderkey", lists.join_packed(F.transform("s", lambda x: x["name"])).alias("cell"))


@query("select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by event_type = 'purchase' desc, event_id) = 1")
def richest_row(t: Tables) -> DataFrame:
    """A complete row beats others; of equals the first seen."""
    complete = C("event_type") == "purchase"
    return t.events.withColumn("k", F.row_number().over(Window.partitionBy("user_id").orderBy(complete.desc(), "event_id"))).where("k = 1").select("user_id", "event_id", "event_type")


@query("with marked as (select *, min(l_partkey * 1000 + l_suppkey) over w as first_line, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey * 1000 + l_suppkey, l_quantity) as k from lineitem window w as (partition by l_orderkey, l_linenumber)) select l_orderkey, l_linenumber, l_partkey * 1000 + l_suppkey as line, first_line from marked where k > 1")
def duplicate_report(t: Tables) -> DataFrame:
    line = C("l_partkey") * 1000 + C("l_suppkey")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", line.alias("line"), "l_quantity")
    same = Window.partitionBy("l_orderkey", "l_linenumber")
    rows = rows.withColumns({"first_line": F.min("line").over(same), "k": F.row_number().over(same.orderBy("line", "l_quantity"))})
    return rows.where("k > 1").drop("k", "l_quantity")


@query("select reason, count(*) as n from (select case when p_partkey % 5 = 0 then 'already' when p_partkey % 3 = 0 then 'dropped: ' || p_type else 'other' end as reason from part) group by reason")
def categorize_lines(t: Tables) -> DataFrame:
    line = F.when(C("p_partkey") % 5 == 0, F.concat(L("[SKIP] "), "p_name", L(" already registered"))).when(C("p_partkey") % 3 == 0, F.concat(L("[SKIP] "), "p_name", L(" ("), "p_type", L(")"))).otherwise("ok")
    pattern = "^\\[SKIP\\] .* \\((.*)\\)$"
    reason = F.when(line.rlike("^\\[SKIP\\].*already"), "already").when(line.rlike(pattern), F.concat(L("dropped: "), F.regexp_extract(line, pattern, 1))).otherwise("other")
    return t.part.select(reason.alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("select l_orderkey, l_partkey, l_suppkey, l_linenumber from (select *, bool_or(l_returnflag = 'R') over (partition by l_orderkey) as has from lineitem) where not (has and l_returnflag = 'A')")
def bool_or_then_drop(t: Tables) -> DataFrame:
    has = F.bool_or(C("l_returnflag") == "R").over(Window.partitionBy("l_orderkey"))
    return t.lineitem.withColumn("has", has).where(~(C("has") & (C("l_returnflag") == "A"))).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query("select l_orderkey, count(*) as n_files, count(*) filter (l_returnflag = 'N') as n_kind, sum(l_quantity::bigint)::bigint as size from lineitem group by l_orderkey")
def dir_stats(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n_files"), F.count_if(C("l_returnflag") == "N").alias("n_kind"), F.sum(C("l_quantity").cast("long")).alias("size"))


# Sequences

PREFIX_SQL = "strftime(o_orderdate, '%Y%m%d') || '-' || substr(o_orderpriority, 1, 1) || '-'"
ASSIGNED_SQL = f"""known as (select {PREFIX_SQL} as prefix, max(o_orderkey % 100) as n from orders where o_orderkey % 2 = 0 group by 1), fresh as (select o_orderkey, {PREFIX_SQL} as prefix from orders where o_orderkey % 2 = 1)"""


def _fresh(t: Tables) -> tuple[DataFrame, DataFrame]:
    prefix = F.concat(F.date_format("o_orderdate", "yyyyMMdd"), L("-"), F.substring("o_orderpriority", 1, 1), L("-")).alias("prefix")
    rows = t.orders.select("o_orderkey", prefix)
    return rows.where("o_orderkey % 2 = 1"), rows.where("o_orderkey % 2 = 0").select("prefix", (C("o_orderkey") % 100).alias("n"))


@query(f"with {ASSIGNED_SQL} select o_orderkey, prefix || printf('%03d', coalesce(n, 0) + row_number() over (partition by prefix order by o_orderkey)) as id from fresh left join known using (prefix)")
def assign_ids(t: Tables) -> DataFrame:
    fresh, known = _fresh(t)
    return sequence.assign_ids(fresh, "prefix", "o_orderkey", known).select("o_orderkey", "id")


@query(f"with {ASSIGNED_SQL}, held as (select {PREFIX_SQL} as prefix, 996::bigint as r from orders where o_orderkey % 10 = 0 group by 1) select o_orderkey, prefix || printf('%03d', greatest(coalesce(n, 0), coalesce(r, 0)) + row_number() over (partition by prefix order by o_orderkey)) as id from fresh left join known using (prefix) left join held using (prefix)")
def assign_ids_reserved(t: Tables) -> DataFrame:
    fresh, known = _fresh(t)
    held = known.where("n % 10 = 0").select("prefix", L(996).cast("long").alias("n"))
    return sequence.assign_ids(fresh, "prefix", "o_orderkey", known, held).select("o_orderkey", "id")


@query(f"with {ASSIGNED_SQL}, lost as (select prefix, count(*) as k from fresh where o_orderkey % 2 = 0 group by prefix) select o_orderkey, prefix || printf('%03d', coalesce(n, 0) + coalesce(k, 0) + row_number() over (partition by prefix order by o_orderkey)) as id from fresh left join known using (prefix) left join lost using (prefix)")
def assign_ids_kept(t: Tables) -> DataFrame:
    """Numbers reserved before they are used. A run that failed had reserved for a part of the cases; its numbers stay a gap."""
    fresh, known = _fresh(t)
    path = tables.scratch(t.spark, "numbers")
    wanted = lambda rows: rows.groupBy("prefix").agg(F.count("*").alias("n"))
    tables.reserve(t.spark, path, wanted(fresh.where("o_orderkey % 2 = 0")), known)
    starts = tables.reserve(t.spark, path, wanted(fresh), known).withColumnRenamed("start", "n")
    return sequence.assign_ids(fresh, "prefix", "o_orderkey", starts).select("o_orderkey", "id")


PATHED_SQL = "paths as (select page_id, split_part(regexp_replace(url, '^https?://', ''), '/', 1) as host, regexp_replace(url, '^https?://', '') as path from pages)"


def _paths(t: Tables) -> DataFrame:
    path = F.regexp_replace("url", "^https?://", "")
    return t.pages.select("page_id", F.substring_index(path, "/", 1).alias("host"), path.alias("path"))


@query(f"with {PATHED_SQL} select host, path from paths qualify row_number() over (partition by host order by len(string_split(path, '/')), path) = 1")
def canonical_min_depth(t: Tables) -> DataFrame:
    return sequence.least_deep(_paths(t), ["host"], "path").select("host", "path")


@query(f"with {PATHED_SQL} select host, dst, path from (select *, regexp_extract(path, '([^/]*)/?$', 1) as dst from paths) qualify row_number() over (partition by host, dst order by len(string_split(path, '/')), path) = 1")
def first_per_dst(t: Tables) -> DataFrame:
    return sequence.least_deep(_paths(t).withColumn("dst", F.regexp_extract("path", "([^/]*)/?$", 1)), ["host", "dst"], "path").select("host", "dst", "path")


@query("select min(doc_id) as doc_id, n_chars, count(*) as n_copies from documents group by sha256(lower(text)), n_chars")
def dedup_name_size(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "n_chars", F.sha2(F.lower("text"), 256).alias("name"))
    return rows.groupBy("name", "n_chars").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies")).drop("name")


@query(
    "with rows as (select p_partkey, lower(p_name || p_size) as name, p_partkey % 6 > 0 as eligible from part), gone as (select distinct name from rows where p_partkey % 29 = 0), "
    "marked as (select r.*, g.name is not null as taken from rows r left join gone g using (name)), placed as (select *, row_number() over (partition by name, eligible and not taken order by p_partkey) as k from marked) "
    "select p_partkey, case when not eligible then 'raw-missing' when taken then 'collision' when k = 1 then 'new' else 'collision' end as claim from placed"
)
def claim_names(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.concat("p_name", C("p_size").cast("string")).alias("name"))
    taken = rows.where("p_partkey % 29 = 0").select(F.upper("name").alias("gone"))
    return sequence.claim_names(rows, "name", "p_partkey", C("p_partkey") % 6 > 0, taken, "gone").select("p_partkey", "claim")


@query("select o_orderkey, coalesce(sum(case when o_orderstatus = 'P' then 1 else 0 end) over (order by o_orderkey rows between unbounded preceding and 1 preceding), 0) >= 100 as deferred from orders where o_orderkey > 0")
def deferred_after_limit(t: Tables) -> DataFrame:
    return sequence.after_limit(t.orders.where("o_orderkey > 0").select("o_orderkey", "o_orderstatus"), "o_orderkey", C("o_orderstatus") == "P", 100).select("o_orderkey", "deferred")


@query("select event_id, user_id, last_value(case when event_type = 'signup' then value end ignore nulls) over (partition by user_id order by event_id) as value from events")
def carry_forward(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", F.when(C("event_type") == "signup", C("value")).alias("value"))
    return grouping.carry_forward(rows, "user_id", "event_id", "value")


@query(f"with {PACKED_SQL}, items as (select order_key, v, min(i) as pos from (select order_key, unnest(string_split(cell, ';')) as v, generate_subscripts(string_split(cell, ';'), 1) as i from packed) group by order_key, v) select order_key, count(*) as n_distinct, arg_min(v, pos) as first_item from items group by order_key")
def ordered_distinct(t: Tables) -> DataFrame:
    items = lists.split_packed(C("cell"))
    return packed_suppliers(t).select("order_key", F.size(items).cast("long").alias("n_distinct"), F.get(items, 0).alias("first_item"))


@query("select c_custkey, 'Case ' || row_number() over (order by c_custkey) || '/' || count(*) over () as progress from customer")
def progress_numbers(t: Tables) -> DataFrame:
    total = t.customer.agg(F.count("*").alias("total"))
    rows = sequence.placed(t.customer.select("c_custkey"), C("c_custkey")).crossJoin(F.broadcast(total))  # one row
    return rows.select("c_custkey", F.format_string("Case %d/%d", "place", "total").alias("progress"))


@query("select case when o_orderstatus = 'P' then 'pending' when o_orderkey % 3 = 0 then 'failed' else 'done' end as outcome, count(*) as n from orders group by outcome")
def outcome_counts(t: Tables) -> DataFrame:
    outcome = F.when(C("o_orderstatus") == "P", "pending").when(C("o_orderkey") % 3 == 0, "failed").otherwise("done")
    return t.orders.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


@query("select l_orderkey, l_returnflag, count(*) as n_objects, min(l_partkey * 1000 + l_suppkey) as first_object from lineitem group by l_orderkey, l_returnflag")
def series_index(t: Tables) -> DataFrame:
    """Objects by series: how many, and the first by name."""
    name = C("l_partkey") * 1000 + C("l_suppkey")
    return t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(F.count("*").alias("n_objects"), F.min_by(name, name).alias("first_object"))


@query("select c_custkey, c_custkey % 2 = 0 and c_custkey % 3 > 0 and trim(c_mktsegment) <> '' and c_acctbal > 0 as complete from customer")
def db_complete(t: Tables) -> DataFrame:
    """Whether a record comes from the database and lacks none of the fields that must be known."""
    source = F.when(C("c_custkey") % 2 == 0, "db").otherwise("pending-db")
    needed = {"sex": F.when(C("c_custkey") % 3 == 0, "unknown").otherwise("F"), "strain": C("c_mktsegment"), "born": F.when(C("c_acctbal") > 0, C("c_acctbal").cast("string")).otherwise(" ")}
    plain = {name: F.lower(text.strip(F.coalesce(value, L("")))) for name, value in needed.items()}
    known = ~plain["sex"].isin("", "unknown") & (plain["strain"] != "") & (plain["born"] != "")
    return t.customer.select("c_custkey", ((source == "db") & known).alias("complete"))
