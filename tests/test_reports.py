import datetime as dt
import zipfile
import zlib
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldoflow.functions.text import column_name
from saldoflow.plans import queries
from saldoflow.sources import reports, storage
from saldoflow.sources.archives import PIECE_BYTES
from saldoflow.sources.schemas import REPORT_TABLES, report_kind

D = dt.date
RUN = D(2025, 1, 31)


@pytest.fixture()
def folder(tmp_path):
    tmp_path = tmp_path / "raw"
    tmp_path.mkdir()
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as z:
        z.writestr("in/recebidos-1.csv", "data;valor depositado;Razão Social/ID\n31/01/2024;1.234,56;Açaí S.A.\nxx;NA;\n")
        z.writestr("capa-1.csv", "a;b\n1;2\n")
        z.writestr("sem prefixo.csv", "a;b\n1;2\n")
        z.writestr("notas-1.txt", "text")
    with zipfile.ZipFile(tmp_path / "two.zip", "w") as z:
        z.writestr("recebidos-2.csv", "data;bandeira\n1/2/2024;visa\n")
        z.writestr("recebidos-3.csv", "")
        z.writestr("recebidos-4.csv", b"a;b\n\xff\xfe;1\n")
        z.writestr("outros-1.csv", "Taxa %;b\n1.5;\"x;y\"\n")
        z.writestr("planilha-1.xlsx", b"no workbook")
    return str(tmp_path)


def test_rows_and_problems(spark, folder):
    rows = reports.report_rows(reports.read_archives(spark, folder)).collect()
    good = {(r["member"], r["line"]): r["values"] for r in rows if not r["problem"]}
    assert set(good) == {("recebidos-1.csv", 1), ("recebidos-1.csv", 2), ("capa-1.csv", 1), ("recebidos-2.csv", 1), ("outros-1.csv", 1)}
    assert good["recebidos-1.csv", 1] == {"data": "31/01/2024", "valor_depositado": "1.234,56", "Razao_Social_ID": "Açaí S.A."}
    assert good["recebidos-1.csv", 2] == {"data": "xx", "valor_depositado": None, "Razao_Social_ID": None}
    assert good["outros-1.csv", 1] == {"Taxa_percent": "1.5", "b": "x;y"}
    assert {r["member"] for r in rows if r["problem"]} == {"recebidos-3.csv", "recebidos-4.csv", "planilha-1.xlsx"}


def test_a_member_counts_as_a_whole_or_not_at_all(spark, tmp_path):
    lines = "a;b\n" + "1;2\n" * 3 * reports.CHUNK_ROWS
    with zipfile.ZipFile(tmp_path / "bad.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("outros-1.csv", lines.encode() + b"\xff;1\n")
        z.writestr("outros-2.csv", "Código/A;Codigo-A\n1;2\n")
        z.writestr("outros-3.csv", lines)
        z.writestr("deep/outros-3.csv", "a;b\n5;6\n")
    (tmp_path / "broken.zip").write_bytes(b"no archive")
    content = (tmp_path / "bad.zip").read_bytes()
    (tmp_path / "cut.zip").write_bytes(content[:100] + bytes([content[100] ^ 1]) + content[101:])
    rows = reports.report_rows(reports.read_archives(spark, str(tmp_path)))
    problems = {(r["archive"].rsplit("/", 1)[-1], r["member"]) for r in reports.report_problems(rows).collect()}
    assert {("bad.zip", "outros-1.csv"), ("bad.zip", "outros-2.csv"), ("broken.zip", None), ("cut.zip", "outros-1.csv")} <= problems
    whole = reports.whole_lines(rows).filter("archive like '%bad.zip'").groupBy("entry").count().collect()
    assert {r["entry"]: r["count"] for r in whole} == {2: 3 * reports.CHUNK_ROWS, 3: 1}


def test_members_of_an_archive_are_read_by_many_tasks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "many.zip", "w") as z:
        for i in range(64):
            z.writestr(f"outros-{i}.csv", "a;b\n1;2\n")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = reports.report_rows(reports.read_archives(spark, str(tmp_path)))
        assert rows.select(F.spark_partition_id()).distinct().count() > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_archives_are_read_by_pieces(spark, tmp_path):
    data = b"a;b\n" + b"1;2\n" * (3 * PIECE_BYTES // 4)
    with zipfile.ZipFile(tmp_path / "one.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("outros-1.csv", data)
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "two.zip").write_bytes(b"not in the folder")
    read = reports.read_archives(spark, str(tmp_path))
    sizes = [r[0] for r in read.select(*[F.max(F.length(c)) for c, t in read.dtypes if t == "binary"]).collect()]
    assert sizes == [PIECE_BYTES]
    assert reports.whole_lines(reports.report_rows(read)).count() == 3 * PIECE_BYTES // 4


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_little_of_a_member_is_held(method):
    data = b"0" * (64 << 20)
    deflate = zlib.compressobj(9, zlib.DEFLATED, -15)
    packed = deflate.compress(data) + deflate.flush() if method == zipfile.ZIP_DEFLATED else data
    pieces = iter([{"data": packed[i:i + PIECE_BYTES], "method": method, "crc": zlib.crc32(data)} for i in range(0, len(packed), PIECE_BYTES)])
    member, buffer, size = reports._Member(pieces, next(pieces)), memoryview(bytearray(8192)), 0
    while some := member.readinto(buffer):
        size += some
        assert len(member.rest) <= PIECE_BYTES
    assert size == len(data)


def test_archives_have_members_of_a_size(spark, tmp_path, monkeypatch):
    lines = spark.range(40_000).select(*[F.col("id").alias(c) for c in ("l_orderkey", "l_partkey", "l_suppkey")], F.lit(1).alias("l_linenumber"),
        F.lit(0.04).alias("l_discount"), F.lit(0.5).alias("l_tax"), F.lit(12.5).alias("l_extendedprice"), F.lit("F").alias("l_linestatus"),
        F.lit(dt.datetime(1998, 1, 1)).alias("l_shipdate"))
    lines.unionByName(lines.limit(1).withColumn("l_orderkey", F.lit(None).cast("long"))).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(queries, "MEMBER_LINES", 600)
    monkeypatch.setattr(storage, "new_folder", lambda _, name: str(tmp_path / name))
    names = [p.name for p in Path(queries._archive_folder(spark, str(tmp_path))).iterdir()]
    assert len(names) >= 17 and {"broken.zip", "0.zip", "15.zip"} <= set(names)
    sizes = []
    for path in (tmp_path / "archives").glob("[0-9]*.zip"):
        with zipfile.ZipFile(path) as z:
            members = [n for n in z.namelist() if n.startswith("Pagamentos-")]
            sizes.append([len(z.read(n).splitlines()) - 1 for n in members])
            assert len(z.namelist()) == len(members) + 6
    assert max(map(max, sizes)) == 600 and sum(map(sum, sizes)) in (40_000, 40_001)


def test_clean_report(spark, folder):
    rows = reports.report_rows(reports.read_archives(spark, folder))
    df = reports.clean_report(rows, "recebidos", RUN)
    assert df.columns == ["updated_on", "Razao_Social_ID", "bandeira", "data", "valor_depositado"]
    assert dict(df.dtypes)["data"] == "date" and dict(df.dtypes)["valor_depositado"] == "double"
    got = sorted([tuple(r) for r in df.collect()], key=repr)
    assert got == sorted([(RUN, "Açaí SA", None, D(2024, 1, 31), 1234.56), (RUN, None, None, None, None),
                          (RUN, None, "visa", D(2024, 2, 1), None)], key=repr)


def test_columns_keep_file_order_if_all_files_agree(spark, folder):
    rows = reports.report_rows(reports.read_archives(spark, folder))
    assert reports.report_columns(rows, "capa") == ["a", "b"]
    assert reports.report_columns(rows, "outros") == ["Taxa_percent", "b"]
    assert reports.report_columns(rows, "recebidos") == ["Razao_Social_ID", "bandeira", "data", "valor_depositado"]


def test_land_reports(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    written = reports.land_reports(reports.read_archives(spark, folder), out, RUN)
    assert set(written.paths) == {"recebidos", "outros"} and written.paths["recebidos"].endswith("/Recebidos")
    read = lambda path: storage.read_table(spark, path)
    assert read(written.paths["recebidos"]).count() == 3
    assert read(written.paths["outros"]).select("Taxa_percent").collect()[0][0] == "15"  # every point goes
    problems = {r["member"]: r["problem"] for r in read(written.problems).collect()}
    assert set(problems) == {"recebidos-3.csv", "recebidos-4.csv", "planilha-1.xlsx"}
    assert [tuple(r) for r in read(written.lost_values).collect()] == [("recebidos", "data", 1)]
    csv = reports.land_reports(reports.read_archives(spark, folder), str(tmp_path / "csv"), RUN, fmt="csv")
    back = read(csv.paths["recebidos"])
    assert back.columns[0] == "updated_on" and back.count() == 3
    with pytest.raises(ValueError, match="can't be read"):
        reports.land_reports(reports.read_archives(spark, folder), out, RUN, strict=True)


def test_decimals_change_every_text_unless_told(spark):
    df = spark.createDataFrame([("1.234,56", "1234.56", "a.b")], "x string, y string, z string")
    assert tuple(reports.normalise_decimals(df).collect()[0]) == ("1234.56", "123456", "ab")
    assert tuple(reports.normalise_decimals(df, ["x"]).collect()[0]) == ("1234.56", "1234.56", "a.b")


@pytest.mark.parametrize("text,date", [
    ("05/02/2024", D(2024, 2, 5)), ("5/2/2024", D(2024, 2, 5)), ("31/12/2024 10:30:00", D(2024, 12, 31)),
    ("2024-12-31", D(2024, 12, 31)), ("01/02/24", D(2024, 2, 1)), ("1/2/99 10:30", D(1999, 2, 1)),
    ("01/02/2024 10:30", D(2024, 2, 1)), ("1.2.2024", D(2024, 2, 1)), ("2024-02-01T10:30:00", D(2024, 2, 1)), ("31/02/2024", None), ("xx", None), ("", None), (None, None),
])
def test_day_first(spark, text, date):
    df = spark.createDataFrame([(text,)], "t string").select(reports.parse_day_first(F.col("t")))
    assert df.collect()[0][0] == date


def test_outer_union_sorts_columns_only_if_they_differ(spark):
    a = spark.createDataFrame([("1", "2")], "b string, a string")
    c = spark.createDataFrame([("3", "4")], "c string, a string")
    assert reports.outer_union([a, a]).columns == ["b", "a"]
    assert reports.outer_union([a, c]).columns == ["a", "b", "c"]


def test_names_and_registry():
    assert column_name("Taxa MDR (%)/Não-pago.") == "Taxa_MDR_(percent)_Nao_pago_"
    assert report_kind("capa") is None
    for kind in REPORT_TABLES:
        entry = report_kind(kind)
        assert entry.schema.fieldNames()[0] == "updated_on"
        assert isinstance(entry.schema[entry.partition_by].dataType, T.DateType)
    assert {k: len(report_kind(k).schema) for k in REPORT_TABLES} == {
        "ajustes": 21, "pagamentos_futuros": 31, "cobrancas_em_aberto": 8, "recebidos": 12, "pagamentos": 31,
        "cancelamentos_e_contestacoes": 27}


def test_publish_replaces_the_table_it_reads(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 1, 2), 2), (None, 3)], "d date, v int")
    storage.publish(rows, path, "d")
    storage.publish(storage.read_table(spark, path).withColumn("v", F.col("v") * 10), path)
    assert sorted(r["v"] for r in storage.read_table(spark, path).collect()) == [10, 20, 30]
    storage.repartition_table(spark, path, "d")
    back = storage.read_table(spark, path)
    assert back.filter("d = date'2024-01-02'").collect()[0]["v"] == 20
    assert back.filter("d is null").count() == 1
    assert len(list((tmp_path / "table").glob("version-*/d=2024-01-01"))) == 1  # the first version is emptied by now
    storage.publish(back.withColumn("v", F.lit(1)), path)
    storage.publish(storage.read_table(spark, path).limit(0), path, "d")
    assert storage.read_table(spark, path).count() == 0 and set(storage.read_table(spark, path).columns) == {"d", "v"}
    assert len(list((tmp_path / "table").glob("version-*/d=2024-01-01"))) == 0  # all but the last two are


def test_a_failed_replace_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    storage.publish(spark.range(3), path)
    with pytest.raises(Exception, match="no luck"):
        storage.publish(spark.range(9).select(F.raise_error(F.lit("no luck")).cast("long").alias("id")), path)
    assert storage.read_table(spark, path).count() == 3
    monkeypatch.setattr(storage, "_switch", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        storage.publish(spark.range(5), path)
    with pytest.raises(ZeroDivisionError):
        storage.land_csv(spark.range(5), path)
    assert storage.read_table(spark, path).count() == 3


def test_two_runs_at_once_leave_one_whole_table(spark, tmp_path):
    path = str(tmp_path / "table")
    storage.publish(spark.range(1), path)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda n: storage.publish(spark.range(n), path), (40, 50)))
    assert storage.read_table(spark, path).count() in (40, 50)


def test_stored_results_are_removed(spark):
    with storage.temporary(spark):
        kept = storage.stored(spark.range(100))
        assert kept.count() == 100
    assert spark.read.parquet(*{f.rsplit("/", 1)[0] for f in kept.inputFiles()}).count() == 0
