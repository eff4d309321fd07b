from __future__ import annotations

import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from catalogue import queries
from heatherd.operators.daily import daily_climate
from heatherd.operators.contracts import check_contract
from heatherd.operators.frame import HUMIDITY_COLUMN, TEMPERATURE_COLUMN
from heatherd.sources import files as station_sources
from heatherd.sources.files import archive_members, batched, header_columns, history_of, skipped_files, station_files, station_history, station_lines
from heatherd.sources.payloads import documents
from heatherd.sources.tables import file_counts, order_violations, parquet_layout, publish, recover_table, write_table

from conftest import SF_SMALL

PREAMBLE = "REGIAO:;NO\nUF:;TO\nESTAÇÃO:;IGARAPÉ FUNDO\nALTITUDE:;27,40\n"
NEW_HEADER = "Data;Hora UTC;PRECIPITAÇÃO TOTAL, HORÁRIO (mm);TEMPERATURA DO AR - BULBO SECO, HORARIA (°C);UMIDADE RELATIVA DO AR, HORARIA (%);\n"
NEW_ROWS = [
    "2017-06-10;0300 UTC;0,4;9,5;91;",
    "2017-06-10;0400 UTC;0,6;9,25;93;",
    "2017-06-10;0500 UTC;;8,75;94;",
    "2017-06-10;1700 UTC;0,0;17,5;61;",
    "2017-06-11;0300 UTC;0,0;71,5;-3;",
    "2017-06-11;0400 UTC;0,0;10,5;88;",
    "2017-06-11;1800 UTC;2,2;16,25;67;",
]
OLD_HEADER = "DATA (YYYY-MM-DD);HORA (UTC);UMIDADE RELATIVA DO AR, HORARIA (%);TEMPERATURA DO AR - BULBO SECO, HORARIA (°C);hora (utc);2;;\n"
OLD_ROWS = ['2001-05-01;"00:00";60;-9999;9;x;;;surplus', "2001-05-01;01:00:00;-9999,0;20", "", "2001-05-02;02:00;NA;21,5;1;y;;"]


@pytest.fixture
def folder(tmp_path):
    new = (PREAMBLE + NEW_HEADER + "\n".join(NEW_ROWS) + "\n").encode("latin-1")
    old = (PREAMBLE + OLD_HEADER + "\r\n".join(OLD_ROWS)).encode("latin-1")
    (tmp_path / "2024").mkdir()
    (tmp_path / "2024" / "leituras_NO_A001_junho.CSV").write_bytes(new)
    (tmp_path / "leituras_NO_B002_maio.csv").write_bytes(old)
    (tmp_path / "no_code.csv").write_bytes(new)
    (tmp_path / "C003_no_header.csv").write_bytes(b"a;b\n1;2\n")
    (tmp_path / "D004_late_header.csv").write_bytes(b"x\n" * 15 + NEW_HEADER.encode("latin-1") + b"2024-01-01;0000 UTC;1;2;3;\n")
    (tmp_path / "E005_no_rows.csv").write_bytes((PREAMBLE + "Data;Only here;\n").encode("latin-1"))
    (tmp_path / "notes.txt").write_text("Data;A001")
    return tmp_path


def test_drifting_headers_match_by_name(spark, folder):
    files = station_files(spark, str(folder))
    names = header_columns(files)
    assert names == ["data", "hora_utc", "precipitacao_total_horario_mm", TEMPERATURE_COLUMN, HUMIDITY_COLUMN]
    rows = station_history(files).collect()
    assert len(rows) == 10
    new = [r for r in rows if r["cd_estacao"] == "A001"]
    assert len(new) == 7 and {r["data"] for r in new} == {"2017-06-10", "2017-06-11"}
    assert [r["precipitacao_total_horario_mm"] for r in new].count(None) == 1
    old = {r["hora_utc"]: r for r in rows if r["cd_estacao"] == "B002"}
    assert set(old) == {"00:00", "01:00:00", "02:00"}
    assert old["00:00"][TEMPERATURE_COLUMN] is None and old["00:00"][HUMIDITY_COLUMN] == "60"
    assert old["01:00:00"][HUMIDITY_COLUMN] is None and old["01:00:00"][TEMPERATURE_COLUMN] == "20"
    assert old["02:00"][HUMIDITY_COLUMN] is None and all(r["precipitacao_total_horario_mm"] is None for r in old.values())


def test_named_columns_and_known_stations(spark, folder):
    files = station_files(spark, str(folder))
    assert station_history(files, ["B002"], ["data", "not_there"]).collect()[0].asDict() == {
        "cd_estacao": "B002", "data": "2001-05-01", "not_there": None,
    }
    registry = spark.createDataFrame([("A001",)], "cd_estacao string")
    assert {r[0] for r in station_history(files, registry, ["data"]).select("cd_estacao").collect()} == {"A001"}


def test_quoted_separator_stays_in_its_field(spark):
    content = 'Data;Hora UTC;Nota\n2024-01-01;0000 UTC;"a;b ""c"""\n'.encode("latin-1")
    files = spark.createDataFrame([("A001.csv", bytearray(content))], "file_name string, content binary")
    assert station_history(files, columns=["nota"]).collect()[0]["nota"] == 'a;b "c"'


def test_files_to_daily_climate(spark, folder):
    days = {r["data"]: r for r in daily_climate(station_history(station_files(spark, str(folder)), ["A001"])).collect()}
    assert set(days) == {dt.date(2017, 6, 10), dt.date(2017, 6, 11)}
    assert days[dt.date(2017, 6, 11)]["temp_max"] == 16.25 and days[dt.date(2017, 6, 11)]["umid_min"] == 67.0


def test_archives(spark, folder, tmp_path_factory):
    root = tmp_path_factory.mktemp("zips")
    with zipfile.ZipFile(root / "2024.zip", "w") as z:
        z.write(folder / "2024" / "leituras_NO_A001_junho.CSV", "2024/deep/leituras_NO_A001_junho.CSV")
        z.writestr("2024/readme.txt", "Data;x")
    with zipfile.ZipFile(root / "2001.ZIP", "w") as z:
        z.write(folder / "leituras_NO_B002_maio.csv", "leituras_NO_B002_maio.csv")
    members = archive_members(station_files(spark, str(root), "zip"))
    assert {r["file_name"] for r in members.collect()} == {"leituras_NO_A001_junho.CSV", "leituras_NO_B002_maio.csv"}
    assert station_history(members).count() == 10
    plan = members._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("_inflated") < plan.index("RepartitionByExpression") < plan.index("_packed_members")
    stored = spark.createDataFrame([("x.zip", bytearray((root / "2024.zip").read_bytes()))] * 2, "file_name string, content binary")
    assert archive_members(stored).count() == 2


def test_skipped_files_are_named(spark, folder):
    skipped = lambda **more: {r[0] for r in skipped_files(station_files(spark, str(folder)), **more).collect()}
    assert skipped() == {"no_code.csv", "C003_no_header.csv", "D004_late_header.csv"}
    assert skipped(header_within=16) == {"no_code.csv", "C003_no_header.csv"}


def test_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"a": 1}], indent=1))
    assert documents(spark, str(tmp_path)).collect()[0]["payload"].count("\n") > 1


def test_sorted_table_layout(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(250_000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    write_table(rows.repartition(5), path, sort=["k", "v"])
    write_table(rows.repartition(1), path, sort=["k", "v"])
    layout = parquet_layout(spark, path).collect()
    assert {r["codec"] for r in layout} == {"ZSTD"}
    assert max(r["rows"] for r in layout) <= 100_000
    assert sum(r["rows"] for r in layout if r["column"] == "k") == 250_000
    assert order_violations(spark, path, ["k", "v"]).agg(F.sum("violations")).collect()[0][0] == 0
    ranges = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(
        F.min(F.struct("k", "v")).alias("low"), F.max(F.struct("k", "v")).alias("high")
    ).orderBy("low").collect()
    assert all(a["high"] < b["low"] for a, b in zip(ranges, ranges[1:]))
    assert file_counts(spark, path).agg(F.sum("rows")).collect()[0][0] == 250_000


def test_order_violations_inside_and_between_runs(spark, tmp_path):
    path = str(tmp_path / "t")
    ids = spark.range(0, 200_000, numPartitions=1)
    # out of order once inside a run and once where two runs of 100,000 rows meet
    key = F.when(F.col("id") == 10, -1).when(F.col("id") >= 100_000, F.col("id") - 150_000).otherwise(F.col("id"))
    ids.select(key.alias("k")).write.parquet(path)
    found = order_violations(spark, path, ["k"]).collect()
    assert [(r["violations"], r["overlaps"]) for r in found] == [(2, False)]


def test_order_of_nulls_and_across_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in ([(None, 1), ("a", None), ("a", 1), ("b", 0)], [("b", 1), ("c", 2), (None, 3)], [("d", 0)]):
        spark.createDataFrame(rows, "k string, v int").coalesce(1).write.mode("append").parquet(path)
    found = sorted((r["violations"], r["overlaps"]) for r in order_violations(spark, path, ["k", "v"]).collect())
    assert found == [(0, False), (0, False), (1, True)]  # the null of the second file belongs into the first
    spark.createDataFrame([("bb", 0)], "k string, v int").coalesce(1).write.mode("append").parquet(path)
    assert sum(r["overlaps"] for r in order_violations(spark, path, ["k", "v"]).collect()) == 2


def test_unreadable_files_are_reported(spark, tmp_path):
    path = str(tmp_path / "inmet_historico_diario")
    write_table(spark.range(3), path)
    (tmp_path / "inmet_historico_diario" / "part-broken.parquet").write_bytes(b"PAR1 not a table")
    assert [(r["check"], r["subject"].rsplit("/", 1)[-1]) for r in check_contract(spark, path, "inmet_historico_diario").collect()] == [
        ("unreadable", "part-broken.parquet")]


def test_partitioned_write_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1, "a"), (2, "b")], "p int, v string"), path, partition_by=["p"])
    write_table(spark.createDataFrame([(2, "c")], "p int, v string"), path, partition_by=["p"])
    assert {(r["p"], r["v"]) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "c")}


# Replacing a table


def hidden(folder):
    return sorted(p.name for p in folder.iterdir() if p.name.startswith("."))


def test_failed_write_leaves_the_table(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.range(100)
    write_table(rows, path, sort=["id"])
    broken = rows.withColumn("id", F.when(F.col("id") == 57, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")))
    for sort in ([], ["id"]):
        with pytest.raises(Exception, match="broken row"):
            write_table(broken, path, sort=sort)
        assert spark.read.parquet(path).count() == 100 and not hidden(tmp_path)


def test_table_can_be_replaced_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(10), path)
    write_table(spark.read.parquet(path).withColumn("id", F.col("id") + 1), path, sort=["id"])
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == list(range(1, 11)) and not hidden(tmp_path)


def test_table_set_aside_comes_back(spark, tmp_path):
    """A process that ended between setting the old table aside and publishing the new one."""
    path = tmp_path / "t"
    write_table(spark.range(10), str(path))
    path.rename(tmp_path / ".t-old")
    recover_table(spark, str(path))
    assert spark.read.parquet(str(path)).count() == 10 and not hidden(tmp_path)
    write_table(spark.range(3), str(tmp_path / ".t-old"))  # left over beside a complete table
    recover_table(spark, str(path))
    assert spark.read.parquet(str(path)).count() == 10 and not hidden(tmp_path)


def test_refused_publication_brings_the_old_table_back(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(10), path)
    with pytest.raises(Exception):
        publish(spark, str(tmp_path / "nothing"), path)
    assert spark.read.parquet(path).count() == 10 and not hidden(tmp_path)
    write_table(spark.range(4), str(tmp_path / "new" / "folder" / "t"))
    assert spark.read.parquet(str(tmp_path / "new" / "folder" / "t")).count() == 4


def test_stored_lines_give_the_same_history(spark, folder):
    files = station_files(spark, str(folder))
    named = station_history(files, columns=header_columns(files))
    lines = station_lines(files)
    assert lines.select("header").distinct().count() == 2  # files without rows have no lines
    for history in (station_history(files), history_of(lines)):
        assert history.columns == named.columns
        assert sorted(map(str, history.collect())) == sorted(map(str, named.collect()))
    assert history_of(lines, ["data"]).columns == ["cd_estacao", "data"]
    assert station_history(files.limit(0)).collect() == []


def test_small_contents_share_a_frame(monkeypatch):
    """Members of an archive go to Spark many at a time, within a limit of rows and one of bytes."""
    monkeypatch.setattr(station_sources, "BATCH_ROWS", 4)
    monkeypatch.setattr(station_sources, "BATCH_BYTES", 10)
    rows = [(str(i), b"x" * n) for i, n in enumerate([1, 1, 1, 1, 9, 2, 50, 0, 3])]
    frames = list(batched(iter(rows), ["file_name", "content"]))
    assert [len(f) for f in frames] == [4, 2, 1, 2]
    assert [tuple(r) for f in frames for r in f.itertuples(index=False)] == rows
    assert list(batched(iter([]), ["content"])) == []


def test_lines_are_not_placed_by_header(spark, folder, tmp_path):
    """Few header lines stand over all lines; a task per header would read its share of the delivery."""
    station_lines(station_files(spark, str(folder))).write.parquet(str(tmp_path / "lines"))
    history = history_of(spark.read.parquet(str(tmp_path / "lines")))
    assert len(history.collect()) == 10
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(header" not in plan, plan


def test_derived_files_do_not_shrink_as_the_table_grows(spark, tmp_path, monkeypatch):
    """A file keeps its lines where order keys go on; a station with many lines has several files."""
    i = F.col("id")
    spark.range(1_200_000).select(
        i.alias("l_orderkey"), (i % 7 + 1).cast("int").alias("l_linenumber"), (i % 1000).alias("l_suppkey"),
        F.lit(10.0).alias("l_quantity"), F.lit(0.01).alias("l_discount"), F.lit(0.02).alias("l_tax"),
        F.timestamp_add("DAY", (i % 60).cast("int"), F.lit("1997-01-01").cast("timestamp")).alias("l_shipdate"),
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    names = queries._station_files(spark, str(tmp_path)).select(F.regexp_extract("file_name", r"_(\d+)\.CSV$", 1).alias("part"))
    assert names.distinct().count() == 6

    columns = ["data", "hora_utc", TEMPERATURE_COLUMN]
    whole = station_sources.station_history(queries._station_files(spark, SF_SMALL), columns=columns)
    monkeypatch.setattr(queries, "FILE_LINES", 2)
    short = queries._station_files(spark, SF_SMALL)
    lines = F.size(F.split(F.decode("content", "ISO-8859-1"), "\r\n")) - 5  # preamble, header and the end
    assert short.agg(F.max(lines)).first()[0] == 2
    assert short.count() == short.select("file_name").distinct().count()
    cut = station_sources.station_history(short, columns=columns)
    assert whole.exceptAll(cut).isEmpty() and cut.exceptAll(whole).isEmpty()


def test_fields_quoted_as_a_whole_need_no_lookahead(spark):
    lines = ['a;"b";c', '"";"x y"', '"a;b";c', '"a""b";"c"', 'a"b;c', '"a;b', ';"";', 'a;b', '"a"b";c', None]
    wanted = [["a", "b", "c"], ["", "x y"], ["a;b", "c"], ['a"b', "c"], ['a"b', "c"], ['"a', "b"], ["", "", ""], ["a", "b"], ['"a"b"', "c"], None]
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, line string")
    found = [r[0] for r in df.orderBy("i").select(station_sources._fields(F.col("line"))).collect()]
    assert found[:-2] == wanted[:-2] and found[-1] is None
    simple = df.filter(F.col("line").rlike(station_sources.WHOLLY_QUOTED)).select("i").collect()
    assert sorted(r[0] for r in simple) == [0, 1, 6, 7]
