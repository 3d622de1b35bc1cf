"""Archives by their members, types from values, and landing by name."""

import datetime as dt
import os
import random
import zipfile
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldoflow.plans import store_queries
from saldoflow.sources import archives, inference, landing, reports, split_csv, storage, tables

RUN = dt.date(2025, 1, 31)


# --- archives ------------------------------------------------------------------------------

def bad_archives(path):
    lines = "a;b\n" + "1;2\n" * 3 * reports.CHUNK_ROWS
    with zipfile.ZipFile(path / "bad.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("outros-1.csv", lines.encode() + b"\xff;1\n")
        z.writestr("outros-2.csv", "Código/A;Codigo-A\n1;2\n")
        z.writestr("outros-3.csv", lines)
        z.writestr("deep/outros-3.csv", "a;b\n5;6\n")
        z.writestr("recebidos-4.csv", "")
        z.writestr("ajustes-1.xlsx", b"a workbook")
        z.writestr("notas.txt", "no report")
    with zipfile.ZipFile(path / "plain.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("x-1.csv", 'a;b\n"1;\n2";é\n')
    (path / "broken.zip").write_bytes(b"no archive")
    content = (path / "bad.zip").read_bytes()
    (path / "cut.zip").write_bytes(content[:100] + bytes([content[100] ^ 1]) + content[101:])
    (path / "sub").mkdir()
    (path / "empty.zip").write_bytes(b"")


def test_members_read_as_whole_archives_do(spark, tmp_path):
    bad_archives(tmp_path)
    old = reports.report_rows(reports.read_archives(spark, str(tmp_path)))
    new = reports.member_rows(spark, str(tmp_path))
    key = lambda df: sorted((os.path.basename(r.archive), r.entry, r.member, r.kind, r.line, repr(r["values"])) for r in reports.whole_lines(df).collect())
    assert key(new) == key(old) and len(key(new)) > 3 * reports.CHUNK_ROWS
    said = lambda df: {(os.path.basename(r.archive), r.member) for r in reports.report_problems(df).collect()}
    assert said(new) == said(old) | {("empty.zip", None)}  # which Spark's own reader passes over


def test_an_archive_is_planned_from_its_directory_alone(tmp_path):
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as z:
        for i in range(50):
            z.writestr(f"outros-{i}.csv", b"x" * 100_000)
    size, read = os.path.getsize(tmp_path / "one.zip"), []

    class Counting:
        def __init__(self, path):
            self.file = open(path, "rb")  # noqa: SIM115

        def read(self, n=-1):
            data = self.file.read(n)
            read.append(len(data))
            return data

        def __getattr__(self, name):
            return getattr(self.file, name)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

    class Store:
        open_input_file = staticmethod(Counting)

    members = list(archives.members_of(Store, "one.zip", str(tmp_path / "one.zip")))
    assert len(members) == 50 and sum(read) < size / 50
    tasks = archives.shared_out(members, 1_000_000)
    assert [len(t.members) for t in tasks] == [10] * 5
    assert [len(t.members) for t in archives.shared_out(members, 10)] == [1] * 50


def test_tasks_have_few_bytes_unless_told():
    members = [archives.Member("a", i, "b-1.csv", "b", size=1 << 20) for i in range(256)]
    tasks = archives.shared_out(members)
    assert max(sum(m.size for m in t.members) for t in tasks) <= 64 << 20 and sum(len(t.members) for t in tasks) == 256


def test_tasks_have_16_mb_unless_told():
    members = [archives.Member("a", i, "b-1.csv", "b", size=1 << 20) for i in range(256)]
    assert [len(t.members) for t in archives.shared_out(members)] == [16] * 16


def test_archives_are_written_as_lines_come(spark, monkeypatch):
    monkeypatch.setattr(store_queries, "MEMBER_LINES", 20)
    wanted = [(None if i % 10 == 0 else i % 3 + 9000 * (i % 7 == 0), f"l{i}") for i in range(300)]
    lines = spark.createDataFrame(wanted, "pedido bigint, nota string")
    folder = store_queries._zip_folder(spark, lines, "pedido", "Outros")
    rows = reports.whole_lines(reports.member_rows(spark, folder)).select("archive", "member", "values").collect()
    key = lambda r: (r[0] or "", r[1])
    assert sorted(((r["values"]["pedido"], r["values"]["nota"]) for r in rows), key=key) == \
        sorted(((None if p is None else str(p), n) for p, n in wanted), key=key)
    members = [(r.archive, r.member) for r in rows]
    assert max(map(members.count, members)) <= 20 and len({a for a, _ in members}) == 3


def test_a_task_reads_its_members_by_pieces(spark, tmp_path):
    data = os.urandom(9_000_000)
    with zipfile.ZipFile(tmp_path / "large.zip", "w") as z:
        z.writestr("outros-1.csv", data)
        z.writestr("outros-2.csv", b"a\n1\n")
    pieces = archives.read_members(spark, str(tmp_path), task_bytes=1_000_000)
    assert pieces.rdd.getNumPartitions() == 2
    rows = sorted(pieces.filter("entry = 0").collect(), key=lambda r: r.piece)
    assert [len(r.data) for r in rows] == [archives.PIECE_BYTES, archives.PIECE_BYTES, 9_000_000 - 2 * archives.PIECE_BYTES]
    assert b"".join(r.data for r in rows) == data


def _state_by_bytes(data, state):
    first = -1
    for i in range(len(data)):
        c = data[i:i + 1]
        if state == split_csv.CLOSING:
            state = split_csv.QUOTED if c == b'"' else split_csv.PLAIN
            if c == b'"':
                continue
        if state == split_csv.QUOTED:
            state = split_csv.CLOSING if c == b'"' else state
        elif c == b'"' and state == split_csv.START:
            state = split_csv.QUOTED
        else:
            first = i + 1 if c == b"\n" and first < 0 else first
            state = split_csv.START if c in (b";", b"\n", b"\r") else split_csv.PLAIN
    return state, first


@given(st.lists(st.sampled_from([b'"', b";", b"\n", b"\r", b"a", b'""', b"bc"]), max_size=20), st.integers(0, 3))
@settings(max_examples=2000)
def test_scan_of_a_range(parts, state):
    assert split_csv.scan(b"".join(parts), state) == _state_by_bytes(b"".join(parts), state)


@given(st.lists(st.sampled_from([b'"', b";", b"\n", b"\r", b"a", b'""', b"bc"]), max_size=20))
def test_scans_from_all_states(parts):
    assert split_csv.scans(b"".join(parts)) == [_state_by_bytes(b"".join(parts), s) for s in range(4)]


def test_ranges_are_dealt_to_tasks_by_their_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(split_csv, "TASK_BYTES", 4096)
    with zipfile.ZipFile(tmp_path / "one.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for n in range(20):
            z.writestr(f"outros-{n}.csv", "a;b\n" + "1;2\n" * 1000)
    parsed = []
    monkeypatch.setattr(split_csv, "stored", lambda df: parsed.append(df.rdd.getNumPartitions()) or storage.stored(df))
    rows = reports.member_rows(spark, str(tmp_path), split_bytes=100, range_bytes=500)
    assert rows.count() == 20_000 and parsed[0] == parsed[-1] == 20


@given(st.binary(max_size=200), st.binary(max_size=5000))
def test_checksums_of_ranges_combine(a, b):
    assert split_csv.combined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_a_large_member_is_read_by_many_tasks(spark, tmp_path, method):
    rnd = random.Random(9)
    cells = ["", "x", '"a;b"', '"two\nlines"', '"say ""hi"""', 'in"ner', "é" * 9, '"' + "\n" * 70 + '"', "NA", '"""\n"', '""']
    lines = ["a;b;c"] + [";".join(rnd.choice(cells) for _ in range(3)) + rnd.choice(["", "", "\r"]) for _ in range(400)] + ["", "1;2;3"]
    wide = [*lines[:300], "1;2;3;4", *lines[300:]]
    with zipfile.ZipFile(tmp_path / "one.zip", "w", method) as z:
        z.writestr("outros-1.csv", "\n".join(lines) + "\n")
        z.writestr("outros-2.csv", "\n".join(lines))
        z.writestr("outros-3.csv", "a;b\n")
        z.writestr("outros-4.csv", "a;b")
        z.writestr("outros-5.csv", "\n".join(wide))
        z.writestr("outros-6.csv", "")
        z.writestr("outros-7.csv", 'a;"b\n' + "open\n" * 40)
        z.writestr("outros-8.csv", b"a;b\n" + b"1;2\n" * 100 + b"\xff;1\n" + b"1;2\n" * 100)
    content = (tmp_path / "one.zip").read_bytes()
    (tmp_path / "cut.zip").write_bytes(content[:100] + bytes([content[100] ^ 1]) + content[101:])
    one = reports.member_rows(spark, str(tmp_path))
    many = storage.stored(split_csv.split_rows(spark, str(tmp_path), archives.list_members(str(tmp_path)), reports._unit_lines,
                                               reports.ROWS_SCHEMA, range_bytes=64))
    key = lambda df: sorted((os.path.basename(r.archive), r.entry, r.member, r.kind, r.line, repr(r["values"])) for r in reports.whole_lines(df).collect())
    assert key(many) == key(one) and len(key(one)) > 800
    said = lambda df: {(os.path.basename(r.archive), r.member) for r in reports.report_problems(df).collect()}
    assert said(many) == said(one)
    assert reports.member_rows(spark, str(tmp_path), split_bytes=100).filter("problem IS NULL").count() >= len(key(one))


def test_a_folder_without_archives(spark, tmp_path):
    assert reports.member_rows(spark, str(tmp_path)).count() == 0


# --- types ---------------------------------------------------------------------------------

@pytest.mark.parametrize(("values", "expected"), [
    ([None, None], "string"), (["1", None, "-20", "0"], "bigint"), (["1", "2.50"], "double"), (["1e5", "-0.25"], "double"),
    (["007", "1"], "string"), (["123456789012345678"], "bigint"), (["1234567890123456789"], "string"),
    (["1234567890123456", "0.5"], "string"), (["31/01/2024", "2024-02-01", "1-2-24"], "date"), (["31/02/2024"], "string"),
    (["31/01/2024", "5"], "string"), (["31/01/2024 10:00"], "string"), (["x"], "string"), ([""], "string"), (["1 "], "string"),
    (["-0"], "string"), (["1.2.3"], "string"),
])
def test_types(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert inference.typed(df).schema["v"].dataType.simpleString() == expected


def test_typed_values_are_not_lost(spark):
    values = ["-12", "2.5E-3", "123456789012345678", "29/02/2024", "x", None]
    pairs = [(a, b) for a in values for b in values]
    df = spark.createDataFrame([tuple(p[0] for p in pairs), tuple(p[1] for p in pairs)], ", ".join(f"c{i} string" for i in range(len(pairs))))
    kinds = inference.kinds(df)
    assert {inference.kind_type(k).simpleString() for k in kinds.values()} == {"string", "bigint", "double", "date"}
    assert reports.lost_values(df, inference.schema_of(kinds)).filter("lost > 0").count() == 0


WIDTH = {"null": 0, "bigint": 1, "double": 2, "date": 2, "string": 3}


@given(st.integers(0, 31), st.integers(0, 31))
@settings(max_examples=200)
def test_more_rows_only_widen(a, b):
    shown = lambda k: "null" if k == 0 else inference.kind_type(k).simpleString()
    both = inference.merged({"c": a}, {"c": b})["c"]
    for one in (a, b):
        assert shown(both) == shown(one) or WIDTH[shown(both)] > WIDTH[shown(one)]


def test_merging_parts_is_reading_the_whole(spark):
    one = spark.createDataFrame([("1", "x"), ("2", None)], "a string, b string")
    two = spark.createDataFrame([("2.5", "1/1/2024")], "a string, c string")
    together = one.unionByName(two, allowMissingColumns=True)
    assert inference.merged(inference.kinds(one), inference.kinds(two)) == inference.kinds(together)


# --- landing -------------------------------------------------------------------------------

def test_landing_by_name(spark, tmp_path):
    def write(n, sales):
        (tmp_path / str(n)).mkdir()
        with zipfile.ZipFile(tmp_path / str(n) / "one.zip", "w") as z:
            z.writestr("recebidos-1.csv", "NSU CV;data;valor depositado;bandeira\n" + sales)
            z.writestr("outros-1.csv", "Taxa %;quando;nota\n1,5;31/01/2024;a\n2;1/2/2024;\n")
            z.writestr("outros-2.csv", "")
            z.writestr("capa-1.csv", "a\n1\n")
        return reports.member_rows(spark, str(tmp_path / str(n)))

    first = write(1, "1;31/01/2024;1.234,56;visa\n2;xx;2,00;visa\n3;01/02/2024;NA;elo\n")
    done = landing.land_tables(first, "by_name_", RUN, keys={"recebidos": ["NSU_CV"]})
    try:
        assert set(done.tables) == {"recebidos", "outros"}
        assert [r.problem.split(":")[0] for r in spark.table(done.problems).collect()] == ["EmptyDataError"]
        others = spark.table(done.tables["outros"])
        assert [f.dataType.simpleString() for f in others.schema] == ["date", "double", "date", "string"]
        assert sorted(r.Taxa_percent for r in others.collect()) == [1.5, 2.0]
        received = spark.table(done.tables["recebidos"])
        by = reports.report_kind("recebidos").partition_by
        assert dict(received.dtypes)[by] == "date" and received.count() == 3
        assert [tuple(r) for r in spark.table(done.lost_values).collect()] == [("recebidos", by, 1)]
        second = write(2, "1;31/01/2024;1.234,56;visa\n2;xx;2,00;visa\n3;01/02/2024;5,00;elo\n4;01/02/2024;6,00;elo\n")
        again = landing.land_tables(second, "by_name_", RUN + dt.timedelta(1), keys={"recebidos": ["NSU_CV"]})
        assert again.changes["recebidos"].dates == ["2024-02-01"]
        stamps = {r.NSU_CV: r.updated_on for r in spark.table(again.tables["recebidos"]).collect()}
        assert stamps == {"1": RUN, "2": RUN, "3": RUN + dt.timedelta(1), "4": RUN + dt.timedelta(1)}
        with pytest.raises(ValueError, match="can't be read"):
            landing.land_tables(second, "by_name_", RUN, strict=True)
        assert spark.table(again.tables["recebidos"]).count() == 4
    finally:
        for name in (*done.tables.values(), done.problems, done.lost_values):
            tables.drop_table(spark, name)


def test_dates_by_shape_as_by_all_patterns_in_turn(spark):
    def in_turn(text):
        short = F.coalesce(*[F.try_to_date(text, p) for p in reports.SHORT_DATE_PATTERNS])
        century = F.when(F.year(short) > reports.LAST_SHORT_YEAR, F.add_months(short, -1200)).otherwise(short)
        return F.coalesce(*[F.try_to_date(text, p) for p in reports.DATE_PATTERNS], century)

    numbers = ["1", "01", "31", "13", "00", "0", "2024", "1999", "69", "001", "-1", "+12345", "29", "2"]
    texts = [s.join((a, b, c)) + t for s in "/.-" for a in numbers for b in numbers for c in numbers
             for t in ("", " 9:05", " 23:59:60", "T1:00:00")[: 4 if a in ("1", "2024") else 1]]
    texts += [None, "", "1 fev", "20240101", " 1/2/2024", "1/2/2024 ", "1-2/2024", "١/٢/٢٠٢٤"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = df.select("t", in_turn(F.col("t")).alias("a"), reports.parse_day_first(F.col("t")).alias("b"))
    assert both.filter("NOT (a <=> b)").collect() == [] and both.filter("a IS NOT NULL").count() > 200


def test_stored_by_kind_is_pruned(spark):
    df = storage.stored(spark.range(10).select((F.col("id") % 2).cast("string").alias("kind"), "id"), by="kind")
    assert isinstance(df.schema["kind"].dataType, T.StringType) and df.filter("kind = '1'").count() == 5
