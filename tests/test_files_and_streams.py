"""Trees, headers, parsers and stateful streams against plain code."""

import hashlib
import json
import os
import random
import struct

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import headers, parsers, trees
from ledgerline.streaming import queues


@pytest.fixture
def tree(tmp_path):
    for a in "abc":
        for k in range(3):
            folder = tmp_path / a / f"mid{k}" / f"scan_{k}" / "deep" / "scan_again"
            folder.mkdir(parents=True)
            (folder.parent / "file.txt").write_text("x" * k)
        (tmp_path / a / "note.txt").write_text("n")
    return tmp_path


def all_below(root):
    found = set()
    for folder, dirs, files in os.walk(root):
        for name in dirs + files:
            parts = os.path.relpath(os.path.join(folder, name), root).split(os.sep)
            at = next((i for i, p in enumerate(parts[:-1]) if p.startswith("scan_")), None)
            found.add((os.path.join(folder, name), len(parts), 0 if at is None else len(parts) - 1 - at))
    return found


@pytest.mark.parametrize("spread", [0, 1, 2, 9])
def test_walks_are_pruned(spark, tree, spread):
    def got(**bounds):
        rows = trees.walked(spark, f"file://{tree}", "^scan_", spread, **bounds)
        return {(r.path, r.depth, r.below) for r in rows.collect()}

    whole = all_below(tree)
    assert got() == whole and trees.walked(spark, str(tree), spread=spread).where("not is_dir and length = 2").count() == 3
    assert got(below=0) == {x for x in whole if x[2] == 0}
    assert got(below=1, depth=4) == {x for x in whole if x[2] < 2 and x[1] <= 4}
    assert got(prefix=f"{tree}/b/mid1") == {x for x in whole if x[0].startswith(f"{tree}/b/mid1")}


def test_uses_of_one_walk_do_not_narrow_each_other(spark, tree):
    whole = all_below(tree)
    rows = trees.walked(spark, str(tree), "^scan_")
    few, more = rows.where("depth <= 1"), rows.where("below = 0")
    shallow, above = {x for x in whole if x[1] <= 1}, {x for x in whole if x[2] == 0}
    assert (few.count(), rows.count(), more.count()) == (len(shallow), len(whole), len(above))
    assert more.unionByName(few).count() == few.unionByName(more).count() == len(shallow) + len(above)
    assert rows.join(few, "path", "left_anti").count() == len(whole) - len(shallow)


def test_pruned_folders_are_never_listed(spark, tree, monkeypatch):
    seen, plain = [], trees.listed
    monkeypatch.setattr(trees, "listed", lambda files, folder: seen.append(os.path.relpath(folder, tree)) or plain(files, folder))

    def listed(**bounds):
        seen.clear()
        reader = trees.TreeReader(str(tree), "^scan_", 1, **bounds)
        for part in reader.partitions():
            list(reader.read(part))
        return sorted(seen)

    assert len(listed()) == 1 + 3 + 9 + 9 + 9 + 9
    anchored = listed(below=0)
    assert len(anchored) == 1 + 3 + 9 and not any("scan_" in x for x in anchored)
    assert listed(depth=2) == [".", "a", "b", "c"]
    assert listed(prefix=f"{tree}/b/mid1", below=0) == [".", "b", "b/mid1"]
    assert trees.walked(spark, str(tree), "^scan_", below=0).count() == 3 + 3 + 9 + 9


def element(tag, kind, value, explicit=True):
    head = struct.pack("<HH", *tag)
    if not explicit:
        return head + struct.pack("<I", len(value)) + value
    return head + kind + (b"\0\0" + struct.pack("<I", len(value)) if kind in headers.LONG_LENGTHS else struct.pack("<H", len(value))) + value


def sequence(explicit=True):
    """One of unknown length, with an item of unknown length and one of known length in it."""
    inner = element((8, 0x60), b"CS", b"XX", explicit)
    items = struct.pack("<HHI", 0xFFFE, 0xE000, 0xFFFFFFFF) + inner + struct.pack("<HHI", 0xFFFE, 0xE00D, 0) + struct.pack("<HHI", 0xFFFE, 0xE000, len(inner)) + inner
    return struct.pack("<HH", 8, 0x50) + (b"SQ\0\0" if explicit else b"") + struct.pack("<I", 0xFFFFFFFF) + items + struct.pack("<HHI", 0xFFFE, 0xE0DD, 0)


def header(kind, name=b"A NAME", explicit=True, syntax=None):
    syntax = syntax or (b"1.2.840.10008.1.2.1" if explicit else b"1.2.840.10008.1.2\0")
    body = sequence(explicit) + element((8, 0x60), b"CS", kind, explicit) + element((8, 0x1070), b"LO", "é ".encode(), explicit) + element((0x10, 0x10), b"PN", name, explicit)
    return b"\0" * 128 + b"DICM" + element((2, 0x10), b"UI", syntax) + body + element((0x7FE0, 0x10), b"OB", b"p" * 4000, explicit)


FIELDS = {"name": (0x10, 0x10), "model": (8, 0x1070)}


def folder_of(spark, tmp_path, files, **how):
    (tmp_path / "case").mkdir()
    for name, content in files.items():
        (tmp_path / "case" / name).write_bytes(content)
    rows = spark.createDataFrame([("case", str(tmp_path / "case" / n)) for n in [*files, "gone"]], "folder string, path string")
    return headers.folder_headers(rows, FIELDS, **({"denied": set()} | how)).collect()


@pytest.mark.parametrize("explicit", [True, False])
def test_headers(spark, tmp_path, explicit):
    files = {"a": header(b"PR", b"NO IMAGE", explicit), "b": header(b"MR", explicit=explicit), "c": b"short", "d": header(b"CT", explicit=explicit), "e": header(b"MR")[:140]}
    (row,) = folder_of(spark, tmp_path, files)
    assert (row.name, row.model, row.modalities, row.instances) == ("A NAME", "é", "MR/PR", 2)
    assert row.bytes_read < 2 * 400


def test_headers_denied_limits_and_none(spark, tmp_path):
    (row,) = folder_of(spark, tmp_path, {f"f{k:03d}": header(b"MR", f"N{k}".encode()) for k in range(60)}, denied={FIELDS["name"]})
    assert (row.name, row.model, row.instances) == ("", "é", 40)
    other = tmp_path / "other"
    other.mkdir()
    assert folder_of(spark, other, {"x": b"no header", "y": header(b"MR", syntax=b"1.2.840.10008.1.2.2\0")}) == []


def test_a_file_over_two_gigabytes_is_read_in_part(spark, tmp_path):
    path = tmp_path / "large"
    with path.open("wb") as f:
        f.write(header(b"MR")[: -4000 - 12] + element((0x7FE0, 0x10), b"OB", b"")[:8] + struct.pack("<I", 3_000_000_000 - (3_000_000_000 % 2)))
        f.truncate(3_000_000_000)
    rows = spark.createDataFrame([("case", str(path))], "folder string, path string")
    (row,) = headers.folder_headers(rows, FIELDS, set()).collect()
    assert row.model == "é" and row.bytes_read < 1000
    assert headers.with_magic(rows, b"DICM").count() == 1 and headers.with_magic(rows, b"DICX").count() == 0


def test_checksums(spark, tmp_path, monkeypatch):
    (tmp_path / "a").write_bytes(os.urandom(3_000_001))
    (tmp_path / "b").write_bytes(b"")
    rows = spark.createDataFrame([(str(tmp_path / n),) for n in "abc"], "path string")
    found = {r.path[-1]: r.sha256 for r in headers.checksums(rows).collect()}
    assert found == {n: hashlib.sha256((tmp_path / n).read_bytes()).hexdigest() for n in "ab"} | {"c": None}


def test_folders_by_content(spark, tmp_path):
    (tmp_path / "1.bin").write_bytes(header(b"MR"))
    (tmp_path / "2.dcm").write_bytes(b"##TITLE=y\n##END=")
    (tmp_path / "3").write_bytes(b" <a/>")
    (tmp_path / "4").write_bytes(b"")
    rows = spark.createDataFrame([(f, str(tmp_path / n), 5) for f in "xy" for n in ("1.bin", "2.dcm", "3", "4", "gone")], "folder string, path string, length long")
    found = sorted((r.folder, r.format, r.files, r.bytes, r.detail) for r in headers.folder_contents(spark, rows).collect())
    assert found == sorted((f, *x, 1, 5, d) for f in "xy" for x, d in ((("dicom",), "MR"), (("parameters",), "##TITLE=y"), (("xml",), "<a/>"), (("other",), "")))


def test_parameter_values():
    said = """##TITLE=  some words
$$ a comment
##$N=12
##$R=-1.50e1
##$ARRAY=( 2, 3 )
1 2.5 x
<a b> -3
##$ONE=( 1 )
7
##$S=( 65 )
<a <b> c>
##$STRINGS=( 2, 20 )
<a>
<b
c>
##$T=(1, <x, (y)>, (2, 3), z)
##$TT=(1, 2) (3)
##$BROKEN=(1, 2
##$EMPTY=
##$N=13
##no record
"""
    expected = {
        "TITLE": "  some words".strip(), "N": 13, "R": -15.0, "ARRAY": [1, 2.5, "x", "<a", "b>", -3], "ONE": 7, "S": "a <b> c", "STRINGS": ["a", "b\nc"], "T": [1, "x, (y)", "(2, 3)", "z"],
        "TT": [[1, 2], [3]], "BROKEN": "(1, 2", "EMPTY": "",
    }
    assert parsers.parameters(said) == expected


def written(value, draw):
    if isinstance(value, list):
        return "(" + draw.choice([", ", ","]).join(f"<{v}>" if isinstance(v, str) else repr(v) for v in value) + ")"
    return f"<{value}>" if isinstance(value, str) else repr(value)


def test_random_parameter_files(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choice([*"ab ,()é", "\nq"]) for _ in range(draw.randint(1, 8)))
    leaf = lambda: draw.choice([draw.randint(-99, 10**12), round(draw.uniform(-5, 5), 3), word()])
    rows = []
    for k in range(200):
        held, lines = {}, []
        for n in range(draw.randint(0, 6)):
            kind = draw.randrange(4)
            name = f"K{n}"
            if kind == 0:
                held[name] = [draw.randint(0, 99) for _ in range(draw.randint(2, 40))]
                lines.append(f"##${name}=( {len(held[name])} )\n" + "".join(f"{x}{draw.choice([' ', chr(10)])}" for x in held[name]))
            elif kind == 1:
                held[name] = leaf()
                lines.append(f"##{name}={written(held[name], draw)}")
            elif kind == 2:
                held[name] = ["t", *(leaf() for _ in range(draw.randint(1, 3)))]  # whole numbers alone would be a size
                lines.append(f"##${name}={written(held[name], draw)}")
            else:
                held[name] = [[word(), *(leaf() for _ in range(draw.randint(0, 2)))] for _ in range(draw.randint(2, 4))]
                lines.append(f"##${name}=" + draw.choice(["\n", " "]).join(written(v, draw) for v in held[name]))
        rows.append((k, "\n$$ no\n".join(lines) + "\n##END=\n", json.dumps(held)))
    df = spark.createDataFrame(rows, "k long, text string, held string")
    got = df.select("k", F.to_json(parsers.parameter_records(F.col("text"))).alias("got"), "held").collect()
    plain = lambda x: json.loads(json.dumps(x), parse_float=float)
    for r in got:
        assert plain(json.loads(r.got)) == plain(json.loads(r.held)), rows[r.k][1]


def test_xml_of_any_shape(spark):
    deep = "<a>" * 5000 + "x" + "</a>" * 5000
    texts = ["<r><d><n>1</n><n><m>é</m></n><e a='1'/></d><d>second</d></r>", "<r>text only</r>", "<r/>", "no xml", None, "<r><d>", "<r><d> a &amp; b <!-- c --></d></r>", f"<r><d><k>{deep}</k></d></r>"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {r.k: r for r in df.select("k", F.to_json(parsers.xml_document(F.col("text"))).alias("j"), F.expr("text is null").alias("n")).where("k < 7").collect()}
    assert [json.loads(got[k].j) for k in range(7)] == [{"n": ["1", {"m": "é"}], "e": ""}, {}, {}, {}, {}, {}, "a & b"]
    level = parsers.document(texts[7])["k"]
    for _ in range(4999):
        level = level["a"]
    assert level == {"a": "x"}


TABLE = [("pending", "found", "open"), ("open", "done", "closed"), ("closed", "found", "open")]


def plain_changes(rows):
    status, steps, found = {}, {}, []
    for key, event, at in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        after = {(a, b): c for a, b, c in TABLE}.get((status.get(key, "pending"), event))
        if after:
            status[key], steps[key] = after, steps.get(key, 0) + 1
            found.append((key, steps[key], after, event))
    return sorted(found)


def test_a_stream_started_again_goes_on(spark, tmp_path):
    draw = random.Random(1)
    schema, parts = "key string, event string, at timestamp", []
    for part in range(3):
        parts.append([(f"k{draw.randint(0, 8)}", draw.choice(["found", "done", "other"]), f"2024-01-0{part + 1} 00:00:{s:02d}") for s in range(40)])
    for part in parts:
        spark.createDataFrame(part, "key string, event string, at string").select("key", "event", F.col("at").cast("timestamp")).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        queues.drained(queues.advancing(stream, TABLE), str(tmp_path / "out"), str(tmp_path / "state"))
    got = sorted((r.key, r.step, r.status, r.event) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == plain_changes([r for p in parts for r in p])


def test_deadlines_pass_in_event_time(spark, tmp_path):
    schema = "key string, event string, at timestamp"
    for part in ([("a", "found", "2024-01-01 00:00:00"), ("b", "found", "2024-01-01 00:00:01"), ("b", "done", "2024-01-01 00:00:05")], [("c", "other", "2024-01-01 01:00:00")], [("c", "other", "2024-01-01 02:00:00")]):
        spark.createDataFrame(part, "key string, event string, at string").select("key", "event", F.col("at").cast("timestamp")).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        queues.drained(queues.advancing(stream, TABLE, waiting="open", expired="given up", deadline_ms=60_000), str(tmp_path / "out"), str(tmp_path / "state"))
    got = sorted((r.key, r.step, r.status, r.event) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("a", 1, "open", "found"), ("a", 2, "given up", "deadline"), ("b", 1, "open", "found"), ("b", 2, "closed", "done")]
