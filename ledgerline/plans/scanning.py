"""Scans of registries, documents, listings and headers; incremental runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import paths, text
from ledgerline.sources import databases, documents, headers, parsers, tables, trees
from ledgerline.streaming import incremental, queues

from .base import Tables, query
from .scalars import cases, cases_sql, json_with_gaps

C, L = F.col, F.lit


@query("select o_orderkey::varchar as o_orderkey, case when o_orderkey % 5 = 0 then '' else o_orderstatus end as o_orderstatus, case when o_orderkey % 7 = 0 then 'two' || chr(10) || 'lines, \"quoted\"' else o_orderpriority end as note from orders")
def scan_registry_csv(t: Tables) -> DataFrame:
    """Written as CSV and read back: blanks, quotes and cells of several lines."""
    note = F.when(C("o_orderkey") % 7 == 0, L('two\nlines, "quoted"')).otherwise(C("o_orderpriority"))
    rows = t.orders.select(C("o_orderkey").cast("string"), F.when(C("o_orderkey") % 5 != 0, C("o_orderstatus")).alias("o_orderstatus"), note.alias("note"))
    path = tables.scratch(t.spark, "registry")
    tables.write_registry(rows.fillna(""), path)
    return tables.read_registry(t.spark, path, rows.columns)


@query("select s_suppkey::varchar as s_suppkey, s_name || ' é' as name from supplier")
def scan_registry_latin1(t: Tables) -> DataFrame:
    """A registry of an older program: bytes that are no UTF-8 are read as Latin-1."""
    rows = t.supplier.select(C("s_suppkey").cast("string"), F.concat("s_name", L(" é")).alias("name"))
    path = tables.scratch(t.spark, "latin1")
    rows.write.csv(path, header=True, encoding="ISO-8859-1", quoteAll=True)
    return tables.read_registry(t.spark, path, rows.columns)


@query("select n_nationkey::varchar as key, n_name || ' é' as name from nation")
def scan_registry_bom(t: Tables) -> DataFrame:
    """A file of few rows that begins with a byte order mark, as spreadsheets write it."""
    lines = t.nation.select(F.concat_ws(",", C("n_nationkey").cast("string"), F.concat("n_name", L(" é"))).alias("value"))
    text_file = F.concat(L("\ufeffkey,name\n"), F.array_join(F.array_sort(F.collect_list("value")), "\n"))
    path = tables.scratch(t.spark, "bom")
    lines.agg(text_file.alias("value")).write.text(path)
    return tables.read_registry(t.spark, path, ["key", "name"])


def nation_files(t: Tables, content: Column, where: str = "true") -> str:
    """A tree with one text file for each nation of ``where``, region=R/nation=N/part-*.txt."""
    root = tables.scratch(t.spark, "tree")
    rows = t.nation.where(where).select(C("n_regionkey").alias("region"), C("n_nationkey").alias("nation"), content.alias("value"))
    rows.repartition("nation").write.partitionBy("region", "nation").text(root)
    return root


def nation_listing(t: Tables, root: str) -> DataFrame:
    folder = F.concat_ws("/", L(root.removeprefix("file:")), F.concat(L("region="), "n_regionkey"), F.concat(L("nation="), "n_nationkey"))
    return t.nation.select("n_nationkey", folder.alias("path"))


def nation_of_path() -> Column:
    return F.regexp_extract("path", "nation=([0-9]+)/", 1).cast("long")


@query("select n_nationkey, case when n_nationkey % 5 < 3 then n_name end as name from nation")
def scan_sidecar_tree(t: Tables) -> DataFrame:
    """A document for each folder of a tree; folders without one and documents that cannot be parsed stay, with null."""
    doc = F.when(C("n_nationkey") % 5 == 3, '{"name":').otherwise(F.to_json(F.struct(C("n_name").alias("name"))))
    root = nation_files(t, doc, "n_nationkey % 5 < 4")
    found = documents.documents_under(t.spark, nation_listing(t, root), "path", root, "part-*.txt")
    return found.select("n_nationkey", F.try_variant_get("doc", "$.name", "string").alias("name"))


@query("select n_nationkey::bigint as nation from nation where n_nationkey % 3 = 0")
def files_by_magic(t: Tables) -> DataFrame:
    root = nation_files(t, F.concat(F.repeat(L("0"), 128), cases(C("n_nationkey"), "DICM", "DICX", ""), "n_name"))
    return documents.files_with_magic(t.spark, root, b"DICM").select(nation_of_path().alias("nation"))


@query("select n_nationkey::bigint as nation, length(n_name)::bigint + 1 as length, sha256(n_name || chr(10)) as sha256 from nation")
def file_checksums(t: Tables) -> DataFrame:
    """Files hashed block by block where they lie."""
    files = documents.discovered(t.spark, nation_files(t, C("n_name")), "part-*.txt")
    return files.join(headers.checksums(files), "path").select(nation_of_path().alias("nation"), "length", "sha256")


def header_text(**elements: Column) -> Column:
    """A header of explicit elements; names tell their tags, kinds and order."""
    texts = [F.concat(L(bytes.fromhex(name[1:9]).decode() + name[-2:]), F.chr(F.octet_length(e)), L("\0"), e) for name, e in elements.items()]
    return F.concat(F.repeat(L("0"), 128), L("DICM"), *texts)


PLACED = {"name": (0x0010, 0x0010), "model": (0x0008, 0x1070), "weight": (0x0010, 0x1030)}


@query("select n_regionkey::varchar as region, '' as name, (select n_name from nation m where m.n_regionkey = n.n_regionkey and m.n_nationkey % 4 <> 3 order by (m.n_nationkey % 4 = 1), m.n_nationkey::varchar limit 1) as model, case when bool_or(n_nationkey % 4 = 1) then 'MR/SR' else 'MR' end as modalities from nation n where n_nationkey % 4 <> 3 group by n_regionkey")
def folder_headers(t: Tables) -> DataFrame:
    """Headers of a folder's files: reports give way to images, denied fields are never read, files without the mark are none."""
    kind = F.when(C("n_nationkey") % 4 == 1, "SR").otherwise("MR")
    header = header_text(t08006000CS=kind, t08007010LO=C("n_name"), t10001000PN=L("A PERSON"))
    root = nation_files(t, F.when(C("n_nationkey") % 4 == 3, "no header").otherwise(header))
    files = documents.discovered(t.spark, root, "part-*.txt").select(F.regexp_extract("path", "region=([0-9]+)/", 1).alias("folder"), "path")
    found = headers.folder_headers(files, PLACED, {PLACED["name"]}, parsed=1000)
    return found.select(C("folder").alias("region"), "name", "model", "modalities")


@query(
    "select n_regionkey::varchar as region, format, count(*) as files, sum(length(content) + 1)::bigint as bytes, case format when 'json' then '' when 'dicom' then 'CT' else '##TITLE=x' end as detail from "
    "(select *, case n_nationkey % 3 when 0 then 'dicom' when 1 then 'parameters' else 'json' end as format, case n_nationkey % 3 when 0 then repeat('0', 142) when 1 then '##TITLE=x' || chr(10) || n_name else '{\"n\":' || n_nationkey || '}' end as content from nation) "
    "group by all"
)
def folder_contents(t: Tables) -> DataFrame:
    """What the folders of a tree hold, told by the bytes of their files and not by their names."""
    content = cases(C("n_nationkey"), header_text(t08006000CS=L("CT")), F.concat(L("##TITLE=x\n"), "n_name"), F.concat(L('{"n":'), "n_nationkey", L("}")))
    files = documents.discovered(t.spark, nation_files(t, content), "part-*.txt").withColumn("folder", F.regexp_extract("path", "region=([0-9]+)/", 1))
    return headers.folder_contents(t.spark, files).withColumnRenamed("folder", "region")


@query("select distinct unnest(['region=' || n_regionkey, 'region=' || n_regionkey || '/nation=' || n_nationkey]) as folder from nation where n_regionkey < 3")
def tree_walk(t: Tables) -> DataFrame:
    """A walk down to folders that are anchors: what lies in them is never listed, nor what lies beside a path's prefix."""
    root = nation_files(t, C("n_name"), "n_regionkey < 3")
    rows = trees.walked(t.spark, root, "^nation=", below=0).where("is_dir")
    return rows.select(F.regexp_extract("path", "(region=.*)$", 1).alias("folder")).where("folder <> ''")


@query("select n_nationkey::bigint as nation, length(n_name)::bigint + 1 as length from nation")
def glob_discovery(t: Tables) -> DataFrame:
    """Files by their names, at any depth; no file is opened, and others beside them are not seen."""
    root = nation_files(t, C("n_name"))
    t.nation.write.mode("append").json(f"{root}/other")
    return documents.discovered(t.spark, root, "part-*.txt").select(nation_of_path().alias("nation"), "length")


@query("select p_partkey, p_name from part where p_size > 10")
def database_scan(t: Tables) -> DataFrame:
    """A table in database files on the shared folder, read by the executors in ranges of rows; the filter is the database's work."""
    path = tables.scratch(t.spark, "database")
    databases.write_database(t.part.select("p_partkey", "p_name", "p_size"), path, "parts")
    rows = databases.database_rows(t.spark, path, "parts", "p_partkey long, p_name string, p_size int", parts=4, where=[("p_size", ">", 10)])
    return rows.select("p_partkey", "p_name")


@query("select c_custkey, case when c_custkey % 4 = 0 then 'new' else c_mktsegment end as segment from customer where c_custkey % 4 < 3")
def publish_versions(t: Tables) -> DataFrame:
    """A table rewritten from itself. A writer that died on the way leaves files that no version names."""
    path = tables.scratch(t.spark, "published")
    tables.publish(t.customer.select("c_custkey", C("c_mktsegment").alias("segment")), path)
    dead = t.customer.select("c_custkey", L("half").alias("segment"))
    dead.write.parquet(f"{path}/data-dead")
    tables.publish(tables.current(t.spark, path).where("c_custkey % 4 < 3"), path)
    now = tables.current(t.spark, path)
    tables.publish(now.withColumn("segment", F.when(C("c_custkey") % 4 == 0, "new").otherwise(C("segment"))), path)
    return tables.current(t.spark, path)


@query("with versions as (select 1 as v union all select 2) select v::int as use, (select count(*) from customer where v = 2 or c_custkey % 2 = 0) as n from versions")
def cached_until_changed(t: Tables) -> DataFrame:
    """A table kept in memory and read again once its files have changed."""
    path = tables.scratch(t.spark, "watched")
    t.customer.where("c_custkey % 2 = 0").select("c_custkey").write.parquet(path)
    watched = tables.Watched(t.spark, path)
    first = watched.get().agg(F.count("*").alias("n")).first()[0]
    assert watched.get() is watched.rows
    t.customer.where("c_custkey % 2 > 0").select("c_custkey").write.mode("append").parquet(path)
    return t.spark.createDataFrame([(1, first)], "use int, n long").unionByName(watched.get().agg(F.count("*").alias("n")).select(L(2).alias("use"), "n"))


@query("select page_id, regexp_extract(url, '^(https?)', 1) as page_scheme, '' as page_owner, length(url)::varchar as page_length from pages")
def exposed_fields(t: Tables) -> DataFrame:
    fields = [
        ("page_scheme", F.regexp_extract("url", "^(https?)", 1), "how the page is reached"),
        ("page_owner", L(None), "left empty: the source's field holds another thing"),
        ("page_length", F.char_length("url"), "length of the address"),
    ]
    return documents.exposed(t.pages, [("page_id", C("page_id"), "key"), *fields]).withColumn("page_id", C("page_id").cast("long"))


@query(
    "select folder, format, count(*) as file_count, round_even(sum(length) / 1e6::double, 1) as total_size_mb, case when format = 'series' then max(lang) end as modality, "
    "case when format = 'slides' then min(doc_id) end as first_slide from (select source as folder, n_chars as length, lang, doc_id, case when lang in ('en', 'fr') then 'series' else 'slides' end as format "
    "from documents where lang <> 'es') group by folder, format"
)
def folder_summaries(t: Tables) -> DataFrame:
    """What each folder holds of each format, by what the format has to say of its files."""
    files = t.documents.select(C("source").alias("folder"), C("n_chars").alias("length"), "lang", "doc_id")
    formats = {"series": C("lang").isin("en", "fr"), "slides": C("lang") != "es"}
    return documents.summarized(files, "folder", formats, {"series": {"modality": F.max("lang")}, "slides": {"first_slide": F.min("doc_id")}})


@query("select event_id, case when props is not null and event_id % 3 = 0 then 'mri' when event_id % 3 = 1 then 'ni' end as section, case when event_id % 3 = 0 then props->>'$.k' when event_id % 3 = 1 then event_type end as metadata from events")
def embedded_metadata(t: Tables) -> DataFrame:
    """Metadata by what a source looks like, a section for each kind; unknown kinds have none."""
    shapes = [("mri", C("props").isNotNull() & (C("event_id") % 3 == 0), F.get_json_object("props", "$.k")), ("ni", C("event_id") % 3 == 1, C("event_type"))]
    return documents.extracted(t.events, shapes).select("event_id", "section", "metadata")


@query("select c_custkey, c_name as name, lower(c_mktsegment) as status from customer")
def scan_projects_trim(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.concat(L(" "), "c_name", L("\t")).alias("name"), F.concat("c_mktsegment", L(" ")).alias("status"))
    return rows.select("c_custkey", text.strip(C("name")).alias("name"), F.lower(text.strip(C("status"))).alias("status"))


@query("select user_id, event_id, event_type from events where user_id % 10 > 0 qualify row_number() over (partition by user_id order by event_id desc) = 1")
def keyed_scan_last_wins(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", F.when(C("user_id") % 10 == 0, " ").otherwise(C("user_id").cast("string")).alias("key"), "event_id", "event_type")
    return tables.last_per_key(rows, "key", "event_id").select("user_id", "event_id", "event_type")


@query("select event_id, case when event_id % 7 = 0 or event_id % 11 = 0 then null else (props->>'$.k')::bigint end as k, event_id % 7 = 0 or event_id % 11 = 0 as no_doc from events")
def scan_json_null_on_bad(t: Tables) -> DataFrame:
    doc = documents.json_or_null(json_with_gaps())
    return t.events.select("event_id", F.variant_get(doc, "$.k", "long").alias("k"), doc.isNull().alias("no_doc"))


@query("select event_id, 'a/' || event_id as path, sha256(event_id::varchar) as hash from events where event_id % 2 = 0 union all select event_id, 'b', 'x' from events where event_id % 2 = 0")
def explode_json_map(t: Tables) -> DataFrame:
    """A row for each file of a manifest, only those whose algorithm is known."""
    algorithm = F.when(C("event_id") % 2 == 0, "SHA256").otherwise("md5")
    doc = F.to_json(F.struct(algorithm.alias("algorithm"), F.create_map(F.concat(L("a\\"), C("event_id").cast("string")), F.sha2(C("event_id").cast("string"), 256), L("b"), L("x")).alias("files")))
    parsed = t.events.select("event_id", F.from_json(doc, "algorithm string, files map<string,string>").alias("m")).where(F.lower("m.algorithm") == "sha256")
    return parsed.select("event_id", F.explode("m.files").alias("path", "hash")).withColumn("path", F.replace("path", L("\\"), L("/")))


@query("select doc_id, source as name, lang || ' ' || n_chars as size, '3' as last from documents")
def parse_kv_header_lines(t: Tables) -> DataFrame:
    header = F.concat(L("##TITLE=x\n##$NAME=<"), "source", L("> $$ note\n$$ all\n##$SIZE=( 2 )\n"), "lang", L("\n"), C("n_chars").cast("string"), L("\n##$LAST=1\n##$LAST=3\n##END="))
    m = documents.labelled_records(header)
    return t.documents.select("doc_id", m.alias("m")).select("doc_id", C("m")["NAME"].alias("name"), C("m")["SIZE"].alias("size"), C("m")["LAST"].alias("last"))


@query(
    "select p_partkey, 'v' || chr(10) || p_name as text, p_size::bigint as second, 3::bigint as n, p_brand as inner_text, p_retailprice::double as price, 'two words' as plain, case when p_partkey % 2 = 0 then 'late' else 'early' end as again, null::varchar as hidden from part"
)
def parse_parameter_arrays(t: Tables) -> DataFrame:
    """Sized arrays, tuples with strings in them, strings over lines, comments, and a key given twice."""
    size, late = C("p_size").cast("string"), F.when(C("p_partkey") % 2 == 0, L("\n##AGAIN=late")).otherwise("")
    header = F.concat(
        L("##$TEXT=( 64 )\n<v\n"), "p_name", L(">\n$$ ##HIDDEN=1\n##$SIZES=( 3 )\n7 "), size, L("\n-1\n##$PAIR=(<"), "p_brand", L(", x>, "), C("p_retailprice").cast("double").cast("string"), L(") (1, 2)\n##PLAIN=two words\n##AGAIN=early"), late, L("\n##END=")
    )
    doc = t.part.select("p_partkey", parsers.parameter_records(header).alias("d"))
    get = lambda path, kind: F.try_variant_get("d", path, kind)
    return doc.select(
        "p_partkey", get("$.TEXT", "string").alias("text"), get("$.SIZES[1]", "long").alias("second"), F.size(F.try_variant_get("d", "$.SIZES", "array<long>")).cast("long").alias("n"), F.split(get("$.PAIR[0][0]", "string"), ", ")[0].alias("inner_text"),
        get("$.PAIR[0][1]", "double").alias("price"), get("$.PLAIN", "string").alias("plain"), get("$.AGAIN", "string").alias("again"), get("$.HIDDEN", "string").alias("hidden"),
    )


@query(
    "select page_id, case when page_id % 3 = 2 then null else url end as url, case when page_id % 3 = 0 then split_part(url, '/', 4) end as lang, case when page_id % 3 = 1 then 2 end::bigint as links, page_id % 3 = 2 as broken from pages"
)
def xml_documents(t: Tables) -> DataFrame:
    """XML of unlike depth: elements that repeat are lists, texts that are no XML are empty documents."""
    url = F.replace("url", L("&"), L("&amp;"))
    lang = F.split("url", "/")[3]
    doc = cases(C("page_id"), F.concat(L("<w><page><url>"), url, L("</url><meta><lang> "), lang, L("\n</lang></meta></page><other/></w>")), F.concat(L("<w><page><url>"), url, L("</url><link>1</link><link><to>2</to></link></page></w>")), F.concat(L("<w><page>"), url))
    rows = t.pages.select("page_id", parsers.xml_document(doc).alias("d"))
    get = lambda path, kind: F.try_variant_get("d", path, kind)
    links = F.size(get("$.link", "array<variant>")).cast("long")
    return rows.select("page_id", get("$.url", "string").alias("url"), get("$.meta.lang", "string").alias("lang"), F.when(links >= 0, links).alias("links"), get("$.url", "string").isNull().alias("broken"))


COLON = "'k: old' || chr(10) || 'k:  ' || source || chr(10) || 'no colon' || chr(10) || 'url: x:' || lang || chr(10) || case when doc_id % 2 = 0 then 'more :' || n_chars else '' end"


@query(
    f"with lines as (select doc_id, unnest(string_split({COLON}, chr(10))) as line, generate_subscripts(string_split({COLON}, chr(10)), 1) as i from documents), "
    "pairs as (select doc_id, i, trim(split_part(line, ':', 1)) as key, trim(substr(line, instr(line, ':') + 1)) as value from lines where contains(line, ':')), "
    "last as (select doc_id, key, arg_max(value, i) as value from pairs group by all) "
    "select doc_id, max(value) filter (key = 'k') as k, max(value) filter (key = 'url') as url, max(value) filter (key = 'more') as more, count(*)::int as n from last group by doc_id"
)
def parse_colon_kv(t: Tables) -> DataFrame:
    more = F.when(C("doc_id") % 2 == 0, F.concat(L("more :"), C("n_chars").cast("string"))).otherwise("")
    m = documents.colon_lines(F.concat(L("k: old\nk:  "), "source", L("\nno colon\nurl: x:"), "lang", L("\n"), more))
    return t.documents.select("doc_id", m.alias("m")).select("doc_id", *(C("m")[k].alias(k) for k in ("k", "url", "more")), F.size("m").alias("n"))


@query("select p_partkey, p_name as first_value, p_brand as second_value, 2::int as n from part")
def from_xml_repeated(t: Tables) -> DataFrame:
    doc = F.concat(L("<r><item><first>name</first><second>"), "p_name", L("</second></item><item><first>brand</first><second>"), "p_brand", L("</second></item></r>"))
    parsed = F.from_xml(doc, "item array<struct<first string, second string>>")["item"]
    return t.part.select("p_partkey", parsed.alias("i")).select("p_partkey", F.get("i", 0)["second"].alias("first_value"), F.get("i", 1)["second"].alias("second_value"), F.size("i").alias("n"))


@query("select c_custkey, c_mktsegment from customer")
def allowlist_projection(t: Tables) -> DataFrame:
    return documents.allowed(t.customer, ["c_custkey", "c_name", "c_mktsegment", "c_phone"], ["C_NAME"])


@query("select doc_id from (select doc_id, repeat('0', 128) || " + cases_sql("doc_id", "'DICM'", "'DICX'", "''") + " || source as content from documents) where substr(content, 129, 4) = 'DICM'")
def binary_magic_filter(t: Tables) -> DataFrame:
    content = F.concat(F.repeat(L("0"), 128), cases(C("doc_id"), "DICM", "DICX", ""), C("source")).cast("binary")
    return t.documents.where(documents.has_magic(content, b"DICM")).select("doc_id")


@query("select page_id, url from pages where regexp_matches(url, '^https://[^/]*/(.*/)?[0-9]+\\.html')")
def glob_like_filter(t: Tables) -> DataFrame:
    """As the glob https://*/**/[0-9]*.html would."""
    return t.pages.where(C("url").rlike("^https://[^/]*/(.*/)?[0-9]+\\.html")).select("page_id", "url")


@query("select page_id, p[2] as lang, p[3] as leaf from (select page_id, string_split(regexp_replace(url, '^https?://', ''), '/') as p from pages where url like 'https://%') where p[2] in ('en', 'fr') and regexp_matches(p[len(p)], '^[0-9]+')")
def path_listing_scan(t: Tables) -> DataFrame:
    rows = t.pages.where(F.startswith("url", L("https://"))).select("page_id", F.split(F.substring("url", 9, (1 << 31) - 1), "/").alias("p"))
    kept = rows.where(F.get("p", 1).isin("en", "fr") & F.element_at("p", -1).rlike("^[0-9]+"))
    return kept.select("page_id", F.get("p", 1).alias("lang"), F.get("p", 2).alias("leaf"))


@query("select distinct regexp_extract(url, '^(https?://[^/]+/[a-z]{2})/', 1) as prefix from pages")
def anchor_prefix_distinct(t: Tables) -> DataFrame:
    """Each folder down to the first that is an anchor, once; what lies below is not walked."""
    return t.pages.select(F.regexp_extract("url", "^(https?://[^/]+/[a-z]{2})/", 1).alias("prefix")).where("prefix <> ''").distinct()


@query("select p_partkey, p_type, regexp_matches(p_type, '^[A-Z]{5}$') as conforms from part")
def split_conforming(t: Tables) -> DataFrame:
    """Conforming names and the others, told apart in one pass."""
    return t.part.select("p_partkey", "p_type", C("p_type").rlike("^[A-Z]{5}$").alias("conforms"))


@query("select distinct unnest([regexp_extract(p_brand, '([0-9]+)', 1), p_size::varchar]) as code from part")
def valid_codes_from_two_columns(t: Tables) -> DataFrame:
    codes = t.part.select(F.explode(F.array_union(F.regexp_extract_all("p_brand", L("([0-9]+)")), F.array(C("p_size").cast("string")))).alias("code")).distinct()
    return tables.required_codes(codes)


@query("select p_partkey, p_name, p_size % 2 = 0 as is_dir from part where p_name not like '%gizmo' order by p_size % 2 = 0 desc, lower(p_name), p_partkey limit 3000")
def list_dirs_first(t: Tables) -> DataFrame:
    rows = t.part.where("p_name not like '%gizmo'").select("p_partkey", "p_name", (C("p_size") % 2 == 0).alias("is_dir"))
    return rows.orderBy(C("is_dir").desc(), F.lower("p_name"), "p_partkey").limit(3000)


# Incremental runs


@query("select o_orderkey, o_custkey from orders where o_orderkey % 3 > 0 and o_custkey not in (select o_custkey from orders where o_orderkey % 3 = 0 and o_orderkey < 1000) qualify row_number() over (partition by o_orderkey) = 1")
def idempotent_rerun(t: Tables) -> DataFrame:
    """Two runs over one source: the second finds everything there."""
    incoming = t.orders.where("o_orderkey % 3 > 0").select("o_orderkey", "o_custkey")
    known = t.orders.where("o_orderkey % 3 = 0 and o_orderkey < 1000").select("o_custkey").distinct()
    first = incremental.new_rows(incoming.join(known, "o_custkey", "left_anti"), incoming.limit(0), ["o_orderkey"])
    second = incremental.new_rows(first, first, ["o_orderkey"])
    return first.unionByName(second).select("o_orderkey", "o_custkey")


@query("select doc_id from documents where doc_id % 4 > 0 and (doc_id % 4 <> 1 or doc_id % 8 = 1)")
def resume_by_stamp(t: Tables) -> DataFrame:
    """Files to fetch again: absent, of another size, or changed by more than two seconds."""
    wanted = t.documents.select("doc_id", F.concat(L("f"), C("doc_id").cast("string")).alias("path"), C("n_chars").alias("size"), (C("doc_id") * 10.0).alias("mtime"))
    k = C("doc_id")
    present = wanted.where(k % 4 < 3).select("path", F.when(k % 4 == 2, C("size") + 1).otherwise(C("size")).alias("size"), F.when(k % 8 == 1, C("mtime") + 3).when(k % 4 == 1, C("mtime") + 2).otherwise(C("mtime")).alias("mtime"))
    return incremental.to_transfer(wanted, present, "path", "size", "mtime").select("doc_id")


TRANSITIONS = [("P", "ok", "linked"), ("P", "no-source", "no-source"), ("O", "ok", "regenerated")]


@query("select o_orderkey, case when o_orderstatus = 'P' and o_orderkey % 2 = 0 then 'linked' when o_orderstatus = 'P' and o_orderkey % 3 = 0 then 'no-source' when o_orderstatus = 'O' and o_orderkey % 2 = 0 then 'regenerated' else o_orderstatus end as status from orders")
def state_transitions(t: Tables) -> DataFrame:
    results = t.orders.where("o_orderkey % 2 = 0 or o_orderkey % 3 = 0").select("o_orderkey", F.when(C("o_orderkey") % 2 == 0, "ok").otherwise("no-source").alias("event"))
    return incremental.advanced(t.orders.select("o_orderkey", C("o_orderstatus").alias("status")), results, "o_orderkey", "status", TRANSITIONS)


QUEUES = [("pending", "found", "recovered"), ("pending", "converted", "regenerated"), ("pending", "no image", "not-applicable"), ("pending", "gone", "no-source"), ("failed", "linked", "linked"), ("pending", "linked", "linked")]


@query(
    "select l_orderkey, l_partkey, l_suppkey, l_linenumber, case when l_returnflag = 'R' and l_linenumber % 2 = 0 then 'linked' when l_returnflag <> 'N' then case when l_returnflag = 'R' then 'failed' else "
    "case l_partkey % 5 when 0 then 'recovered' when 1 then 'regenerated' when 2 then 'not-applicable' when 3 then 'no-source' else 'pending' end end else 'linked' end as status from lineitem"
)
def queue_transitions(t: Tables) -> DataFrame:
    """Queues of several kinds by one table of transitions; what it does not name leaves a state as it is."""
    queue = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", cases(F.when(C("l_returnflag") == "R", 1).when(C("l_returnflag") == "A", 0).otherwise(2), "pending", "failed", "linked").alias("status"))
    queue = queue.withColumn("id", F.struct("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    event = F.when((C("status") == "failed") & (C("l_linenumber") % 2 == 0), "linked").when(C("status") != "failed", cases(C("l_partkey"), "found", "converted", "no image", "gone", "unheard of"))
    results = queue.select("id", event.alias("event")).dropDuplicates(["id"])
    return incremental.advanced(queue, results, "id", "status", QUEUES).drop("id")


@query("select o_orderkey, case when o_orderstatus = 'P' and o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R') then 'done' else o_orderstatus end as status from orders")
def crash_reconcile(t: Tables) -> DataFrame:
    present = t.lineitem.where("l_returnflag = 'R'").select(C("l_orderkey").alias("o_orderkey"))
    return incremental.reconciled(t.orders.select("o_orderkey", C("o_orderstatus").alias("status")), present, "o_orderkey", "status", "P")


@query("select event_id, user_id, strftime(ts, '%Y-%m') as month from events")
def stream_append(t: Tables) -> DataFrame:
    """A file stream appended to a registry that has a part of it, then run again over the same files."""
    base = tables.scratch(t.spark, "stream")
    rows = t.events.select("event_id", "user_id", F.date_format("ts", "yyyy-MM").alias("month"))
    rows.unionByName(rows.where("event_id % 2 = 0")).write.parquet(f"{base}/in")
    rows.where("event_id % 6 = 0").write.partitionBy("month").parquet(f"{base}/registry")
    for run in ("a", "b"):
        incremental.append_stream(t.spark, f"{base}/in", rows.schema, f"{base}/registry", f"{base}/{run}", ["event_id"], "month")
    return t.spark.read.schema(rows.schema).parquet(f"{base}/registry")


STEPS = [("pending", "view", "seen"), ("seen", "click", "chosen"), ("chosen", "purchase", "bought"), ("seen", "purchase", "bought"), ("bought", "view", "seen")]
EVENTS_SQL = "select user_id, event_type, ts, row_number() over (partition by user_id order by ts, event_type) as k from events"
STEPS_SQL = " ".join(f"when status = '{a}' and event_type = '{b}' then '{c}'" for a, b, c in STEPS)


@query(
    f"with recursive e as ({EVENTS_SQL}), walk as (select user_id, 0::bigint as k, 0::bigint as step, 'pending' as status from (select distinct user_id from events) union all "
    f"select w.user_id, e.k, step + (case {STEPS_SQL} end is not null)::int, coalesce(case {STEPS_SQL} end, status) from walk w join e on e.user_id = w.user_id and e.k = w.k + 1) "
    "select user_id::varchar as key, max(step)::bigint as steps, arg_max(status, k) as status from walk group by user_id having max(step) > 0"
)
def queue_stream(t: Tables) -> DataFrame:
    """Items that advance with a stream of events, stopped half way and started again from its checkpoint."""
    base = tables.scratch(t.spark, "queue")
    rows = t.events.select(C("user_id").cast("string").alias("key"), C("event_type").alias("event"), C("ts").alias("at"))
    middle = rows.agg(F.percentile_approx("at", 0.5)).first()[0]
    for half in (C("at") <= middle, C("at") > middle):
        rows.where(half).write.mode("append").parquet(f"{base}/in")
        stream = t.spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        queues.drained(queues.advancing(stream, STEPS), f"{base}/changes", f"{base}/state")
    changes = t.spark.read.schema(queues.RESULT).parquet(f"{base}/changes")
    return changes.groupBy("key").agg(F.max("step").alias("steps"), F.max_by("status", "step").alias("status"))


@query("select strftime(time_bucket(interval 6 hour, ts), '%Y-%m-%d %H:%M') as start, event_type, count(*) as n, round(sum(value), 2) as total from events group by all")
def window_counts(t: Tables) -> DataFrame:
    """An extension: tumbling windows of event time."""
    rows = incremental.windowed(t.events, "ts", "6 hours", ["event_type"], total=F.round(F.sum("value"), 2))
    return rows.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm"))


@query(
    "with w as (select time_bucket(interval 6 hour, ts) as start, event_type, count(*) as n, round(sum(value), 2) as total from events group by all) "
    "select strftime(start, '%Y-%m-%d %H:%M') as start, event_type, n, total from w where start + interval 6 hour <= (select max(ts) from events) - interval 1 day"
)
def window_stream(t: Tables) -> DataFrame:
    """An extension: the windows that a stream of events has closed, stopped half way and started again from its checkpoint."""
    base = tables.scratch(t.spark, "windows")
    middle = t.events.agg(F.percentile_approx("ts", 0.5)).first()[0]
    for half in (C("ts") <= middle, C("ts") > middle):
        t.events.select("ts", "event_type", "value").where(half).write.mode("append").parquet(f"{base}/in")
        stream = t.spark.readStream.schema("ts timestamp_ntz, event_type string, value double").parquet(f"{base}/in")
        incremental.closed_windows(stream, f"{base}/out", f"{base}/state", "ts", "6 hours", ["event_type"], "1 day", total=F.round(F.sum("value"), 2))
    rows = t.spark.read.schema("start timestamp_ntz, event_type string, n long, total double").parquet(f"{base}/out")
    return rows.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm"))
