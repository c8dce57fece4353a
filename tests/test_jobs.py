"""The reference's script chain as jobs: matrix -> daily -> yearly -> zones -> statistics."""

import os

from dryspell.plans import jobs
from dryspell.session import ensure_checkpoint_dir
from dryspell.sources import readers

META = ["code", "institution", "source", "name", "altitude", "lat", "lon", "basin_code", "basin_name",
        "subbasin_code", "subbasin_name", "obs_start", "obs_end", "obs_count", "auto_start"]
STATIONS = [("0101", "DGA", -30.0, -70.0), ("0102", "DMC", -30.5, -70.5), ("0201", "DGA", -40.0, -72.0),
            ("0999", "GHCN", -35.0, -71.0)]


def scratch_tables(spark):
    folder = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_job_chain(spark, tmp_dir):
    days = [f"2001-01-{d:02d}" for d in range(1, 11)] + [f"2002-01-{d:02d}" for d in range(1, 11)]
    mpath = os.path.join(tmp_dir, "matrix.txt")
    with open(mpath, "w") as f:
        for field in META:
            vals = []
            for code, inst, lat, lon in STATIONS:
                vals.append({"code": code, "institution": inst, "lat": str(lat), "lon": str(lon)}.get(field, "x"))
            f.write(",".join([field] + vals) + "\n")
        for i, label in enumerate(days):
            f.write(",".join([label] + [str(float((i + k) % 5)) for k in range(len(STATIONS))]) + "\n")
    spath = os.path.join(tmp_dir, "stations.csv")
    with open(spath, "w") as f:
        f.write(",".join(META) + "\n")
        for code, inst, lat, lon in STATIONS:
            f.write(",".join([code, inst, "s", "n", "1.0", str(lat), str(lon)] + ["x"] * 6 + ["1", "x"]) + "\n")
    bpath = os.path.join(tmp_dir, "bnd.csv")
    with open(bpath, "w") as f:
        f.write("region,feature_id,seq,x,y\n")
        f.write("1,0,0,300000.0,6700000.0\n1,0,1,300000.0,6600000.0\n")
        f.write("2,0,0,300000.0,5600000.0\n2,0,1,300000.0,5500000.0\n")

    daily = os.path.join(tmp_dir, "daily")
    jobs.preprocess(spark, mpath, daily)
    assert readers.read_daily(spark, daily).count() == 3 * len(days)
    yearly = os.path.join(tmp_dir, "yearly")
    jobs.yearly(spark, daily, yearly, min_days=10)
    regions = os.path.join(tmp_dir, "regions")
    jobs.region_table(spark, spath, bpath, regions, boundaries_fmt="csv")
    got = dict((r.code, r.zone) for r in readers.read_zone_lookup(spark, regions).collect())
    assert got == {"101": 1, "102": 1, "201": 2, "999": 1}
    scratch = scratch_tables(spark)
    out = os.path.join(tmp_dir, "stats")
    jobs.zone_statistics(spark, yearly, spath, out, lookup_path=regions)
    spi = spark.read.parquet(os.path.join(out, "yearly-spi-by-zone")).collect()
    assert sorted((r.zone, r.year) for r in spi) == [(1, 2001), (1, 2002), (2, 2001), (2, 2002)]
    clim = spark.read.parquet(os.path.join(out, "mean-yearly-precip-lat-lon-zone")).collect()
    assert sorted(r.code for r in clim) == ["101", "102", "201"]
    jobs.region_table(spark, spath, bpath, regions, boundaries_fmt="csv", mode="overwrite")
    assert scratch_tables(spark) == scratch      # jobs leave no intermediate tables
    nz = os.path.join(tmp_dir, "natural")
    jobs.natural_zone_table(spark, spath, nz)
    out2 = os.path.join(tmp_dir, "stats-natural")
    jobs.zone_statistics(spark, yearly, spath, out2, lookup_path=nz, kind="natural")
    med = spark.read.parquet(os.path.join(out2, "median-year-zone")).collect()
    assert sorted((r.zone, r.year) for r in med) == [(2, 2001), (2, 2002), (4, 2001), (4, 2002)]


def test_command_line_natural_zones(spark, tmp_dir):
    spath = os.path.join(tmp_dir, "stations.csv")
    with open(spath, "w") as f:
        f.write(",".join(META) + "\n")
        for code, inst, lat, lon in STATIONS:
            f.write(",".join([code, inst, "s", "n", "1.0", str(lat), str(lon)] + ["x"] * 6 + ["1", "x"]) + "\n")
    out = os.path.join(tmp_dir, "nz")
    jobs.main(["natural-zones", spath, out])
    got = sorted((r.code, r.zone) for r in readers.read_zone_name_lookup(spark, out).collect())
    assert got == [("101", 2), ("102", 2), ("201", 4), ("999", 3)]


def test_job_chain_in_reference_text_formats(spark, tmp_dir):
    days = [f"2003-02-{d:02d}" for d in range(1, 6)]
    mpath = os.path.join(tmp_dir, "matrix.txt")
    with open(mpath, "w") as f:
        for field in META:
            vals = [{"code": c, "institution": i, "lat": str(la), "lon": str(lo)}.get(field, "x")
                    for c, i, la, lo in STATIONS]
            f.write(",".join([field] + vals) + "\n")
        for i, label in enumerate(days):
            f.write(",".join([label] + [str(float(i + k)) for k in range(len(STATIONS))]) + "\n")
    daily = os.path.join(tmp_dir, "daily-tsv")
    jobs.preprocess(spark, mpath, daily, fmt="tsv")
    text = sorted(r.value for r in spark.read.text(daily).collect())
    assert len(text) == 3 * len(days) and text[0] == "101\t2003\t02\t01\t0.0"
    yearly = os.path.join(tmp_dir, "yearly-tsv")
    jobs.yearly(spark, daily, yearly, min_days=5, fmt="tsv")
    lines = sorted(r.value for r in spark.read.text(yearly).collect())
    assert lines == ["101##2003\t5\t10.0", "102##2003\t5\t15.0", "201##2003\t5\t20.0"]
    monthly = os.path.join(tmp_dir, "monthly-tsv")
    jobs.monthly(spark, daily, monthly, fmt="tsv")
    assert sorted(r.value for r in spark.read.text(monthly).collect())[0] == "101##2003##02\t5\t10.0"


def test_daily_table_columns_in_schema_order(spark, tmp_dir):
    d = spark.createDataFrame([("1", 2000, 1, 2, 3.0)], "code string, year int, month int, day int, precip double")
    p = os.path.join(tmp_dir, "daily")
    d.write.partitionBy("year").parquet(p)
    back = readers.read_daily(spark, p)
    assert back.columns == ["code", "year", "month", "day", "precip"]
    assert [tuple(r) for r in back.collect()] == [("1", 2000, 1, 2, 3.0)]


def test_command_line_preprocess_and_yearly(spark, tmp_dir):
    mpath = os.path.join(tmp_dir, "m.txt")
    with open(mpath, "w") as f:
        for field in META:
            vals = [{"code": c, "institution": i, "lat": str(la), "lon": str(lo)}.get(field, "x")
                    for c, i, la, lo in STATIONS]
            f.write(",".join([field] + vals) + "\n")
        for d in range(1, 4):
            f.write(",".join([f"2005-06-0{d}"] + ["2.0"] * len(STATIONS)) + "\n")
    daily = os.path.join(tmp_dir, "daily")
    yearly = os.path.join(tmp_dir, "yearly")
    jobs.main(["preprocess", mpath, daily])
    jobs.main(["yearly", daily, yearly, "--min-days", "3"])
    got = sorted((r.code, r.year, r.days, r.precip) for r in spark.read.parquet(yearly).collect())
    assert got == [("101", 2005, 3, 6.0), ("102", 2005, 3, 6.0), ("201", 2005, 3, 6.0)]


def test_preprocess_reuses_a_header_table(spark, tmp_dir):
    mpath = os.path.join(tmp_dir, "m.txt")
    with open(mpath, "w") as f:
        for field in META:
            vals = [{"code": c, "institution": i, "lat": str(la), "lon": str(lo)}.get(field, "x")
                    for c, i, la, lo in STATIONS]
            f.write(",".join([field] + vals) + "\n")
        f.write(",".join(["2007-01-01"] + ["1.0"] * len(STATIONS)) + "\n")
    header = os.path.join(tmp_dir, "header")
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    jobs.preprocess(spark, mpath, a, header_out=header)
    jobs.preprocess(spark, mpath, b, header_in=header)
    ra = sorted(tuple(r) for r in readers.read_daily(spark, a).collect())
    rb = sorted(tuple(r) for r in readers.read_daily(spark, b).collect())
    assert ra == rb == [("101", 2007, 1, 1, 1.0), ("102", 2007, 1, 1, 1.0), ("201", 2007, 1, 1, 1.0)]


def test_preprocess_does_not_scan_the_text_for_heads(spark, tmp_dir):
    """Heads come from each file's start: a file is read to its end once."""
    from dryspell.sources.readers import read_matrix_heads
    mpath = os.path.join(tmp_dir, "m.txt")
    with open(mpath, "w") as f:
        for i in range(15):
            f.write(f"field{i},x\n")
        for i in range(200_000):
            f.write("2000-01-01,1\n")
    heads = read_matrix_heads(spark, [mpath])
    assert [r.value for r in heads.orderBy("field").collect()] == [f"field{i},x" for i in range(15)]
    plan = spark.read.text(mpath).limit(15)._jdf.queryExecution().executedPlan().toString()
    assert "CollectLimit" in plan
