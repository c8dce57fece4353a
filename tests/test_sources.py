"""Readers and writers: file round trips in the reference's formats."""

import os
import re

import pytest
from pyspark.sql import functions as F

from dryspell import schemas as S
from dryspell.operators.ingest import daily_from_matrix
from dryspell.sources import matrix_heads, readers, sinks

META = ["code", "institution", "source", "name", "altitude", "lat", "lon", "basin_code", "basin_name",
        "subbasin_code", "subbasin_name", "obs_start", "obs_end", "obs_count", "auto_start"]


def _write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_matrix_files_melt(spark, tmp_dir):
    d = os.path.join(tmp_dir, "matrix")
    os.makedirs(d)
    for k, (codes, vals) in enumerate([(["0001", "0002"], ["1.5", "-9999"]), (["0003"], ["2.0"])]):
        meta = []
        for field in META:
            if field == "code":
                meta.append(",".join([field] + codes))
            elif field == "institution":
                meta.append(",".join([field] + ["DGA"] * len(codes)))
            elif field == "lat":
                meta.append(",".join([field] + ["-30.0"] * len(codes)))
            elif field == "lon":
                meta.append(",".join([field] + ["-70.0"] * len(codes)))
            else:
                meta.append(",".join([field] + ["x"] * len(codes)))
        _write(os.path.join(d, f"part{k}.txt"), meta + [",".join(["1999-12-31"] + vals)])
    out = daily_from_matrix(readers.read_matrix_lines(spark, d))
    got = sorted((r.code, r.year, r.month, r.day, r.precip) for r in out.collect())
    assert got == [("1", 1999, 12, 31, 1.5), ("3", 1999, 12, 31, 2.0)]


def test_station_csv_quotes_and_blank_lines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "stations.csv")
    header = ",".join(META)
    row1 = '00012,DGA,src,"Name, with comma",10.5,-33.0,-70.0,b,bn,s,sn,1990-01-01,2018-12-31,100,'
    row2 = '13,DMC,src,Plain,20.0,-34.0,-71.0,b,bn,s,sn,1990-01-01,2018-12-31,200,2000-01-01'
    _write(p, [header, row1, "", row2, ""])
    df = readers.read_stations(spark, p)
    rows = df.orderBy("code").collect()
    assert [r.code for r in rows] == ["00012", "13"]
    assert rows[0].name == "Name, with comma" and rows[0].lat == -33.0 and rows[1].obs_count == 200


def test_keyed_tsv_roundtrip(spark, tmp_dir):
    y = spark.createDataFrame([("12", 2000, 350, 800.5), ("A7", 2001, 346, 0.0)],
                              "code string, year int, days long, precip double")
    p = os.path.join(tmp_dir, "yearly")
    sinks.write_keyed_tsv(y, p, ["code", "year"], ["days", "precip"])
    text = spark.read.text(p).collect()
    assert sorted(r.value for r in text) == ["12##2000\t350\t800.5", "A7##2001\t346\t0.0"]
    back = readers.read_yearly_keyed(spark, p)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in y.collect())


def test_zone_lookups(spark, tmp_dir):
    p = os.path.join(tmp_dir, "station-regions.csv")
    _write(p, ["0012,3", "COM00080002,5", "12,4"])
    got = sorted(tuple(r) for r in readers.read_zone_lookup(spark, p).collect())
    assert got == [("12", 4), ("COM00080002", 5)]
    q = os.path.join(tmp_dir, "natural-zones.tsv")
    _write(q, ["0007\tCentro", "8\tAtlantis"])
    got = sorted(tuple(r) for r in readers.read_zone_name_lookup(spark, q).collect())
    assert got == [("7", 3), ("8", 0)]


def test_partitioned_write_prunes(spark, tmp_dir):
    rows = [(r, 0, s, float(s), float(r)) for r in range(3) for s in range(2)]
    b = spark.createDataFrame(rows, "region int, feature_id int, seq int, x double, y double")
    p = os.path.join(tmp_dir, "bnd")
    sinks.write_partitioned(b, p, by="region")
    assert sorted(d for d in os.listdir(p) if d.startswith("region=")) == ["region=0", "region=1", "region=2"]
    one = readers.read_boundaries(spark, p).where(F.col("region") == 1)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "region" in plan
    assert one.count() == 2


def test_monthly_keyed_roundtrip(spark, tmp_dir):
    m = spark.createDataFrame([("0012", 2000, 3, 31, 12.5), ("B7", 2001, 12, 28, 0.0)],
                              "code string, year int, month int, days long, precip double")
    p = os.path.join(tmp_dir, "monthly")
    sinks.write_keyed_tsv(m, p, ["code", "year", "month"], ["days", "precip"])
    assert sorted(r.value for r in spark.read.text(p).collect())[0] == "0012##2000##03\t31\t12.5"
    back = sorted(tuple(r) for r in readers.read_monthly_keyed(spark, p).collect())
    assert back == [("12", 2000, 3, 31, 12.5), ("B7", 2001, 12, 28, 0.0)]


def test_boundaries_in_other_formats(spark, tmp_dir):
    rows = [(1, 0, 0, 1.0, 2.0), (1, 0, 1, 3.0, 4.0), (2, 0, 0, 5.0, 6.0)]
    b = spark.createDataFrame(rows, "region int, feature_id int, seq int, x double, y double")
    pj = os.path.join(tmp_dir, "bnd-json")
    b.write.json(pj)
    assert sorted(tuple(r) for r in readers.read_boundaries(spark, pj, fmt="json").collect()) == rows
    pc = os.path.join(tmp_dir, "bnd-csv-by-region")
    sinks.write_partitioned(b, pc, by="region", fmt="csv")
    back = readers.read_boundaries(spark, pc, fmt="csv").where(F.col("region") == 2).collect()
    assert [tuple(r) for r in back] == [(2, 0, 0, 5.0, 6.0)]


def _small_matrix(path, code, value, end="\n"):
    fields = {"code": code, "institution": "DGA", "lat": "-30.0", "lon": "-70.0"}
    lines = [f"{f},{fields.get(f, 'x')}" for f in S.STATION_FIELDS] + [f"2010-05-06,{value}", ""]
    with open(path, "w", newline="") as fh:
        fh.write(end.join(lines))


def test_heads_of_many_files_take_one_job(spark, tmp_dir):
    """10,000 files: the heads are one job, and the melt finds every file's own head."""
    n = 10_000
    for i in range(n):
        _small_matrix(os.path.join(tmp_dir, f"m{i:05d}.txt"), f"{i + 1:06d}", i % 50)
    lines = readers.read_matrix_lines(spark, tmp_dir)
    files = lines.inputFiles()
    assert len(files) == n
    spark.sparkContext.setJobGroup("heads", "heads")
    try:
        heads = readers.read_matrix_heads(spark, files)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("heads")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert heads.count() == 15 * n and heads.where("field = 0").select("value").distinct().count() == n
    got = daily_from_matrix(lines, heads=heads).agg(F.count("code"), F.sum("precip")).first()
    assert got[:] == (n, sum(i % 50 for i in range(n)))


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_heads_of_odd_names_and_line_ends(spark, tmp_dir, end):
    folder = os.path.join(tmp_dir, "a b%20=c")
    os.makedirs(folder)
    for name in ("x y.txt", "ñ+1%.txt"):
        _small_matrix(os.path.join(folder, name), "007", 3, end)
    lines = readers.read_matrix_lines(spark, folder)
    assert sorted(map(tuple, daily_from_matrix(lines).collect())) == [("7", 2010, 5, 6, 3.0)] * 2
    heads = readers.read_matrix_heads(spark, lines.inputFiles())
    scanned = readers.scan_matrix_heads(spark, [folder])
    assert sorted(map(tuple, heads.collect())) == sorted(map(tuple, scanned.collect()))


def test_first_lines_read_no_more_than_they_need(tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "m.txt")
    with open(path, "w") as fh:
        fh.write("﻿head,é\r\nsecond\r\n\r\n" + "x" * 1000)
    for chunk in (1, 2, 7, 1 << 18):
        monkeypatch.setattr(matrix_heads, "CHUNK", chunk)
        assert matrix_heads.first_lines(f"file://{path}", 2) == ["head,é", "second"]
    assert len(matrix_heads.first_lines(path, 9)) == 4
    open(path, "w").close()
    assert matrix_heads.first_lines(path, 3) == []


def test_matrix_lines_are_split_once(spark, tmp_dir):
    _small_matrix(os.path.join(tmp_dir, "m.txt"), "007", 3)
    plan = daily_from_matrix(readers.read_matrix_lines(spark, tmp_dir))._jdf.queryExecution().optimizedPlan().toString()
    line = re.search(r"Relation \[(value#\d+),", plan).group(1)
    assert len(re.findall(rf"split\({line},", plan)) == 1
