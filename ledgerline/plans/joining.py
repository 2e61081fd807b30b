"""Joins, lookups and classifications."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import lists, paths, text
from ledgerline.operators import lookup, sequence

from .base import ACQ_SQL, PACKED_SQL, Tables, acquisitions, packed_suppliers, query
from .scalars import cases, cases_sql

C, L = F.col, F.lit


@query("select o_orderkey, o_orderstatus, ord from (select unnest([500, 3, 99999999, 42, 7]) as k, unnest([1, 2, 3, 4, 5])::bigint as ord) join orders on k = o_orderkey order by ord")
def lookup_in_request_order(t: Tables) -> DataFrame:
    asked = t.spark.createDataFrame([(500, 1), (3, 2), (99999999, 3), (42, 4), (7, 5)], "o_orderkey long, ord long")
    twice = t.orders.unionByName(t.orders.where("o_orderkey = 42").withColumn("o_orderstatus", L("old"))).withColumn("line", F.when(C("o_orderstatus") == "old", 0).otherwise(1))
    return lookup.in_request_order(F.broadcast(asked), twice, "o_orderkey", "ord", "line").select("o_orderkey", "o_orderstatus", "ord")


@query("select l_orderkey, l_partkey, l_suppkey, l_linenumber, coalesce(case when s_suppkey % 4 > 0 then s_name end, 'S' || l_suppkey) as name from lineitem left join supplier on l_suppkey = s_suppkey")
def explode_left_fallback(t: Tables) -> DataFrame:
    """A block for each item of a list; a thin row of the key alone where there is no block."""
    blocks = t.supplier.where("s_suppkey % 4 > 0").select(C("s_suppkey").alias("key"), F.struct(C("s_name").alias("name")).alias("block"))
    rows = t.lineitem.join(blocks, C("l_suppkey") == C("key"), "left")
    block = F.coalesce("block", F.struct(F.concat(L("S"), C("l_suppkey").cast("string")).alias("name")))
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", block["name"].alias("name"))


TERMS = "asked as (select c_custkey as n, " + cases_sql("c_custkey", "c_custkey::varchar", "upper(c_name)", "'nobody'") + " as term from customer)"


def asked(t: Tables) -> DataFrame:
    return t.customer.select(C("c_custkey").alias("n"), cases(C("c_custkey"), C("c_custkey").cast("string"), F.upper("c_name"), "nobody").alias("term"))


@query(f"with {TERMS} select n, min(c_custkey) as found from asked left join customer on term = c_custkey::varchar or lower(term) = lower(c_name) group by n")
def resolve_name_or_id(t: Tables) -> DataFrame:
    return lookup.by_id_or_name(asked(t), "term", t.customer.select("c_custkey", "c_name", C("c_custkey").alias("line")), "c_custkey", "c_name", "line").select("n", "found")


@query(f"with {TERMS} select n, case when n % 3 = 2 then 'nobody' else n::varchar end as found from asked")
def resolve_id_then_name(t: Tables) -> DataFrame:
    return lookup.by_id_then_name(asked(t), "term", t.customer.select("c_custkey", "c_name", C("c_custkey").alias("line")), "c_custkey", "c_name", "line").select("n", "found")


@query("select o_orderkey, case when c_custkey % 5 > 0 then '/projects/' || c_name else '' end as folder from orders left join customer on o_custkey = c_custkey")
def lookup_folder(t: Tables) -> DataFrame:
    folders = t.customer.where("c_custkey % 5 > 0").select(C("c_custkey").alias("key"), F.concat(L("/projects/"), "c_name").alias("folder"))
    return t.orders.join(folders, C("o_custkey") == C("key"), "left").select("o_orderkey", F.coalesce("folder", L("")).alias("folder"))


@query("select p_partkey, s_acctbal as value, s_suppkey is not null as matched from part left join (select * from supplier where s_suppkey < 30) on p_size = s_suppkey")
def transformed_key_join(t: Tables) -> DataFrame:
    """'LOT_007' against '7 old': each side's key is transformed; a second row of a key never counts."""
    right = t.supplier.where("s_suppkey < 30").select(F.concat(C("s_suppkey").cast("string"), L(" old")).alias("key"), C("s_suppkey").alias("line"), C("s_acctbal").alias("value"))
    right = right.unionByName(right.select("key", (C("line") + 1000).alias("line"), L(0.0).alias("value")))
    left = F.regexp_replace(text.key_transform(F.concat(L("LOT_"), F.lpad(C("p_size").cast("string"), 3, "0")), "strip_prefix:LOT_"), "^0+(?=.)", "")
    found = lookup.transformed_join(t.part, left, right, text.key_transform(C("key"), "first_token"), "line", ["value"])
    return found.select("p_partkey", "value", C("_matched").alias("matched"))


@query("select n_nationkey, (select min(r_name) from region) as note from nation")
def cross_constant(t: Tables) -> DataFrame:
    """A table of one row attached to every case."""
    return t.nation.crossJoin(F.broadcast(t.region.agg(F.min("r_name").alias("note")))).select("n_nationkey", "note")


@query("select c_custkey, n_name, r_name from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def dim_chain_join(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, C("c_nationkey") == C("n_nationkey")).join(t.region, C("n_regionkey") == C("r_regionkey")).select("c_custkey", "n_name", "r_name")


@query("select p_partkey, case when p_partkey % 3 = 0 then 1 when p_type in ('SMALL', 'MEDIUM') then 3 end::int as found from part")
def exact_then_prefix_join(t: Tables) -> DataFrame:
    """Keys of a table are type/size forms; the exact one comes first, then one that goes on after the asked key."""
    table = t.spark.createDataFrame([("K0", 1), ("SMALL-x", 3), ("SMALL/y", 4), ("MEDIUM/a", 3), ("LARGEX", 9), ("K0-z", 7)], "k string, v int")
    asked = t.part.select("p_partkey", F.when(C("p_partkey") % 3 == 0, "K0").otherwise(C("p_type")).alias("key"))
    return lookup.exact_then_prefix(asked, "key", F.broadcast(table), "k", "v").select("p_partkey", "found")


@query("select o_orderkey, coalesce(string_agg(strftime(l_shipdate, '%Y-%m-%d') || l_returnflag, ',' order by l_shipdate, l_returnflag), '') as steps from orders left join lineitem on o_orderkey = l_orderkey group by o_orderkey")
def nest_ordered_children(t: Tables) -> DataFrame:
    nested = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_shipdate", "l_returnflag"))).alias("s"))
    steps = F.array_join(F.transform("s", lambda x: F.concat(F.date_format(x["l_shipdate"], "yyyy-MM-dd"), x["l_returnflag"])), ",")
    return t.orders.join(nested, C("o_orderkey") == C("l_orderkey"), "left").select("o_orderkey", F.coalesce(steps, L("")).alias("steps"))


@query("select o_orderkey from orders o where not exists (select 1 from orders k where k.o_orderkey % 3 = 0 and strftime(k.o_orderdate, '%Y%m%d') = strftime(o.o_orderdate, '%Y%m%d') and k.o_custkey = o.o_custkey)")
def anti_dedup_two_keys(t: Tables) -> DataFrame:
    """New orders: no known one of the day and customer. Known rows with a blank name never count."""
    day = F.date_format("o_orderdate", "yyyyMMdd")
    known = t.orders.where("o_orderkey % 3 = 0").select(day.alias("day"), C("o_custkey").alias("name")).where("name is not null")
    rows = t.orders.select("o_orderkey", day.alias("day"), C("o_custkey").alias("name"))
    return rows.join(known, ["day", "name"], "left_anti").select("o_orderkey")


@query("select o_orderkey from orders o where not exists (select 1 from orders k where k.o_orderkey % 2 = 0 and k.o_orderpriority in ('1-URGENT', '2-HIGH') and k.o_orderdate = o.o_orderdate and k.o_orderpriority = o.o_orderpriority)")
def anti_digits_key(t: Tables) -> DataFrame:
    """Stamps in two spellings are one key once all but their digits are gone."""
    digits = lambda c: F.substring(F.regexp_replace(c, "[^0-9]", ""), 1, 14)
    known = t.orders.where("o_orderkey % 2 = 0 and o_orderpriority in ('1-URGENT', '2-HIGH')").select(digits(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("stamp"), "o_orderpriority")
    rows = t.orders.select("o_orderkey", digits(F.date_format("o_orderdate", "yyyyMMddHHmmss")).alias("stamp"), "o_orderpriority")
    return rows.join(known, ["stamp", "o_orderpriority"], "left_anti").select("o_orderkey")


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus in ('F', 'P'))")
def anti_not_linked(t: Tables) -> DataFrame:
    linked = t.orders.where(C("o_orderstatus").isin("F", "P")).select("o_custkey")
    return t.customer.join(linked, C("c_custkey") == C("o_custkey"), "left_anti").select("c_custkey")


@query("select l_orderkey, l_partkey, l_suppkey, l_linenumber, c_name from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey where l_returnflag = 'R'")
def two_hop_join(t: Tables) -> DataFrame:
    rows = t.lineitem.where("l_returnflag = 'R'").join(t.orders, C("l_orderkey") == C("o_orderkey")).join(t.customer, C("o_custkey") == C("c_custkey"))
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "c_name")


@query(f"with {PACKED_SQL}, touched as (select v, min(order_key) as first_order from (select order_key, unnest(string_split(cell, ';')) as v from packed where order_key % 50 = 0) group by v) select v as project, first_order from touched")
def semi_touched(t: Tables) -> DataFrame:
    """The projects that a set of acquisitions touches, each once, with the first that does."""
    ids = t.orders.where("o_orderkey % 50 = 0").select("o_orderkey")
    rows = packed_suppliers(t).join(ids, C("order_key") == C("o_orderkey"), "left_semi")
    return rows.select("order_key", F.explode(lists.split_packed(C("cell"))).alias("project")).groupBy("project").agg(F.min("order_key").alias("first_order"))


@query(f"with {PACKED_SQL} select order_key from packed where list_has_any(string_split(cell, ';'), ['S1', 'S20', 'S33'])")
def filter_arrays_overlap(t: Tables) -> DataFrame:
    return packed_suppliers(t).where(F.arrays_overlap(lists.split_packed(C("cell")), F.array(L("S1"), L("S20"), L("S33")))).select("order_key")


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem left join (select * from part where p_partkey % 100 <> 7) on l_partkey = p_partkey where p_partkey is null")
def fk_violations(t: Tables) -> DataFrame:
    return t.lineitem.join(t.part.where("p_partkey % 100 <> 7"), C("l_partkey") == C("p_partkey"), "left_anti").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("select 'd/' || doc_id as path, case when doc_id % 10 = 1 then 'missing' when doc_id % 10 = 2 then 'mismatched' when doc_id % 10 = 3 then 'extra' else 'ok' end as status from documents")
def fixity_full_outer(t: Tables) -> DataFrame:
    key, digest = F.concat(L("d/"), C("doc_id").cast("string")), F.sha2("text", 256)
    recorded = t.documents.where("doc_id % 10 <> 3").select(F.replace(key, L("/"), L("\\")).alias("path"), F.upper(digest).alias("hash"))
    actual = t.documents.where("doc_id % 10 <> 1").select(key.alias("path"), F.when(C("doc_id") % 10 == 2, "0").otherwise(digest).alias("hash"))
    actual = actual.unionByName(t.spark.createDataFrame([("README.md", "1"), ("checksums.json", "2")], "path string, hash string"))
    return lookup.compared(recorded, actual, "path", "hash", ["README.md", "checksums.json"])


@query("select o_orderkey, '{\"order\":' || o_orderkey || ',\"project\":{\"name\":\"' || c_name || '\"},\"place\":\"' || n_name || '\"}' as doc from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey")
def merge_documents(t: Tables) -> DataFrame:
    """One document of several sources; keys of the base are never overwritten."""
    rows = t.orders.join(t.customer, C("o_custkey") == C("c_custkey"), "left").join(t.nation, C("c_nationkey") == C("n_nationkey"), "left")
    doc = F.struct(C("o_orderkey").alias("order"), F.struct(C("c_name").alias("name")).alias("project"), C("n_name").alias("place"))
    return rows.select("o_orderkey", F.to_json(doc).alias("doc"))


WORDS = {"the": "brain", "ther": "liver", "ing": "lung", "ción": "heart", "keit": "kidney", "eau": "spleen", "un": "bone"}
LINES = {"tionea": "HELA"}


def words_sql(text: str) -> str:
    order = list(LINES.items()) + sorted(WORDS.items(), key=lambda w: -len(w[0]))
    return "case " + " ".join(f"when contains(lower({text}), '{w}') then '{v}'" for w, v in order) + " end"


@query(f"select doc_id, {words_sql('text')} as region from documents")
def longest_keyword_match(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", lookup.longest_keyword(C("text"), WORDS, LINES).alias("region"))


@query("select p.page_id, arg_min('P' || w.page_id, (-length(w.page_id::varchar), w.page_id)) as longest from pages p join pages w on contains(p.url, w.page_id::varchar) group by p.page_id union all select page_id, null from pages p where not exists (select 1 from pages w where contains(p.url, w.page_id::varchar))")
def vocabulary_match(t: Tables) -> DataFrame:
    """The longest word of a vocabulary of some size, a table's keys, in each text."""
    keys = [r[0] for r in t.pages.select("page_id").orderBy("page_id").collect()]  # a vocabulary is bounded by keywords.MOST_CHARS
    return t.pages.select("page_id", lookup.longest_keyword(C("url"), {str(k): f"P{k}" for k in keys}).alias("longest"))


RULES = [("(?i)phantom|promo", "skip"), ("(?i)small.*ring|ring.*small", "tiny ring"), ("(?i)\\bred\\b", "red thing"), ("(?i)ring|bolt", "hardware")]


@query("select p_partkey, case when regexp_matches(v, '(?i)phantom|promo') then 'skip' when regexp_matches(v, '(?i)small.*ring|ring.*small') then 'tiny ring' when regexp_matches(v, '(?i)\\bred\\b') then 'red thing' when regexp_matches(v, '(?i)ring|bolt') then 'hardware' else 'none' end as kind from (select p_partkey, p_name || ' ' || p_type as v from part)")
def first_match_rules(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", lookup.first_match(F.concat_ws(" ", "p_name", "p_type"), RULES, "none").alias("kind"))


@query("select p_partkey, case when p_brand = 'Brand#2' and p_size = 5 then 'cortex' when contains(p_name, 'ring') then 'R' when contains(p_name, 'red') then 'D' end as region, case when p_brand = 'Brand#2' and p_size = 5 then 'code' when contains(p_name, 'ring') or contains(p_name, 'red') then 'keyword' end as source from part")
def code_then_keyword(t: Tables) -> DataFrame:
    codes = t.spark.createDataFrame([("Brand#2", "C5", "cortex")], "owner string, code string, region string")
    rows = t.part.withColumn("code", F.concat(L(" c"), C("p_size").cast("string")))
    return lookup.code_then_keyword(rows, "p_brand", "code", C("p_name"), F.broadcast(codes), {"ring": "R", "red": "D"}).select("p_partkey", "region", "source")


@query("select page_id, case when lang in ('en', 'de') then lang when split_part(regexp_replace(url, '^https?://', ''), '/', 1) like 'm.%' then 'm' end as code from (select *, regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1) as lang from pages)")
def walkup_valid_code(t: Tables) -> DataFrame:
    """The innermost part of a path that is a valid code."""
    parts = F.filter(F.split(F.regexp_replace(F.regexp_replace("url", "^https?://", ""), "^m[.]", "m/"), "/"), lambda x: x != "")
    return t.pages.select("page_id", paths.last_valid(parts, F.array(L("en"), L("de"), L("m"))).alias("code"))


@query("select o_orderkey, case when o_orderkey % 4 = 0 then null else c_name end as repaired, case when o_orderkey % 4 = 0 then 'unresolved' else 'repair' end as action from orders join customer on o_custkey = c_custkey where o_orderkey % 2 = 0")
def repair_worklist(t: Tables) -> DataFrame:
    """Broken rows with what would mend them; those that nothing mends are marked."""
    broken = t.orders.where("o_orderkey % 2 = 0").select("o_orderkey", F.when(C("o_orderkey") % 4 != 0, C("o_custkey")).alias("key"))
    rows = broken.join(t.customer, C("key") == C("c_custkey"), "left")
    return rows.select("o_orderkey", C("c_name").alias("repaired"), F.when(C("c_name").isNull(), "unresolved").otherwise("repair").alias("action"))


@query("select l_orderkey, count(*) as n, count(*) filter (abs(l_extendedprice * 1.0000000001 - first_price) < 1e-6) as n_close from (select *, first_value(l_extendedprice) over (partition by l_orderkey order by l_linenumber, l_suppkey, l_partkey, l_extendedprice) as first_price from lineitem) group by l_orderkey")
def tolerance_compare(t: Tables) -> DataFrame:
    """Each line against its order's first, equal within a tolerance."""
    first = lookup.first_per_key(t.lineitem, "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice").select("l_orderkey", C("l_extendedprice").alias("first_price"))
    close = F.abs(C("l_extendedprice") * 1.0000000001 - C("first_price")) < 1e-6
    return t.lineitem.join(first, "l_orderkey").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(close).alias("n_close"))


@query("select p_partkey from part where lower(p_name) in (select lower(p_name) from part where p_partkey < 20)")
def existing_targets(t: Tables) -> DataFrame:
    listing = t.part.where("p_partkey < 20").select(F.lower("p_name").alias("name"))
    return t.part.join(listing, F.lower("p_name") == C("name"), "left_semi").select("p_partkey")


@query("select outcome, count(*) as n from (select case when c_custkey % 7 = 0 then 'no animal' when o_orderkey % 5 = 0 then 'no document' when o_orderkey % 3 = 0 then 'nothing to fill' else 'recovered' end as outcome from orders join customer on o_custkey = c_custkey where o_orderstatus = 'P') group by outcome")
def recovery_outcomes(t: Tables) -> DataFrame:
    """A queue against two sources; the first thing that stands in the way is the outcome."""
    queue = t.orders.where("o_orderstatus = 'P'").select("o_orderkey", "o_custkey")
    animals = t.customer.where("c_custkey % 7 <> 0").select(C("c_custkey").alias("a"))
    docs = t.orders.where("o_orderkey % 5 <> 0").select(C("o_orderkey").alias("d"), (C("o_orderkey") % 3 == 0).alias("full"))
    rows = queue.join(animals, C("o_custkey") == C("a"), "left").join(docs, C("o_orderkey") == C("d"), "left")
    outcome = F.when(C("a").isNull(), "no animal").when(C("d").isNull(), "no document").when(C("full"), "nothing to fill").otherwise("recovered")
    return rows.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


@query("select p_partkey, case when p_partkey % 11 = 0 then 'no section' when p_partkey % 7 = 0 then 'no block' when p_partkey % 5 = 0 then 'already set' when contains(p_name, 'red') or p_brand = 'Brand#2' then 'fill' else 'no derivation' end as outcome, case when p_partkey % 11 > 0 and p_partkey % 7 > 0 and p_partkey % 5 > 0 then case when contains(p_name, 'red') then 'rule' when p_brand = 'Brand#2' then 'override' end end as source from part")
def backfill_plan(t: Tables) -> DataFrame:
    """What a back-fill would do with each row. Rules come first; an override counts only where they yield nothing."""
    overrides = t.spark.createDataFrame([("Brand#2", "cortex")], "brand string, region string")
    rows = t.part.join(F.broadcast(overrides), C("p_brand") == C("brand"), "left").withColumn("rule", lookup.first_match(C("p_name"), [("(?i)red", "skin")]))
    k = C("p_partkey")
    outcome = F.when(k % 11 == 0, "no section").when(k % 7 == 0, "no block").when(k % 5 == 0, "already set").when(F.coalesce("rule", "region").isNull(), "no derivation").otherwise("fill")
    source = F.when(outcome == "fill", F.when(C("rule").isNotNull(), "rule").otherwise("override"))
    return rows.select("p_partkey", outcome.alias("outcome"), source.alias("source"))


@query(f"select doc_id, case when doc_id % 3 < 2 then {words_sql('text')} end as region, regexp_matches(lower(text), '(^|[^a-z])(for|with)([^a-z]|$)') and doc_id % 2 = 0 as control from documents")
def bestguess_plan(t: Tables) -> DataFrame:
    """A guess for fields that are unset; NA counts as unset."""
    given = cases(C("doc_id"), L(None), L("NA"), L("set"))
    region = F.when(text.is_na(given), lookup.longest_keyword(C("text"), WORDS, LINES))
    control = F.lower("text").rlike("(?<![a-z])(for|with)(?![a-z])") & (C("doc_id") % 2 == 0)
    return t.documents.select("doc_id", region.alias("region"), control.alias("control"))


@query(
    "select c_custkey, new_name, case when errors <> '' then errors when row_number() over (partition by lower(new_name) order by c_custkey) > 1 then 'collides' else '' end as problem from "
    "(select c_custkey, c_mktsegment || '-' || c_nationkey || case when c_custkey % 40 = 0 then ':' else '' end as new_name, case when c_custkey % 40 = 0 then 'illegal character' else '' end as errors from customer)"
)
def rename_plan(t: Tables) -> DataFrame:
    """New names with what forbids them, a name that an earlier row has in any case included."""
    new = text.normalize_name(F.concat_ws(" ", "c_mktsegment", C("c_nationkey").cast("string")))
    rows = t.customer.select("c_custkey", F.concat(new, F.when(C("c_custkey") % 40 == 0, ":").otherwise("")).alias("new_name"))
    rows = rows.withColumn("errors", F.array_join(text.name_errors(C("new_name")), ";"))
    rows = sequence.with_summary(rows, F.lower("new_name"), first=F.min("c_custkey"))
    earlier = C("c_custkey") > C("first")
    return rows.select("c_custkey", "new_name", F.when(C("errors") != "", C("errors")).when(earlier, "collides").otherwise("").alias("problem"))
