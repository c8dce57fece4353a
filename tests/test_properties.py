"""Property tests: the melt against a direct computation, on random matrices."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dryspell.operators.ingest import daily_from_matrix

META = ["code", "institution", "source", "name", "altitude", "lat", "lon", "basin_code", "basin_name",
        "subbasin_code", "subbasin_name", "obs_start", "obs_end", "obs_count", "auto_start"]

codes = st.one_of(st.from_regex(r"0{0,3}[1-9][0-9]{0,5}", fullmatch=True),
                  st.from_regex(r"[A-Z]{2}0{0,2}[0-9]{1,4}", fullmatch=True))
station = st.tuples(codes, st.sampled_from(["DGA", "DMC", "GHCN"]),
                    st.sampled_from([-18.0, -17.9, -30.0, -54.99, -55.0, -60.0]),
                    st.sampled_from([-76.0, -75.99, -70.0, -66.01, -66.0]))
value = st.one_of(st.sampled_from(["-9999", "-9999.000", "-9999.7", "-9998.9", "0"]),
                  st.floats(min_value=0, max_value=500, allow_nan=False).map(lambda v: repr(round(v, 1))))


def _expected(stations, days):
    out = []
    for j, (code, inst, lat, lon) in enumerate(stations):
        if inst == "GHCN" or not (-76.0 < lon < -66.0 and -55.0 < lat < -18.0):
            continue
        canon = str(int(code)) if code.isdigit() else code
        for label, vals in days:
            v = float(vals[j])
            if int(v) == -9999:
                continue
            y, m, d = (int(p) for p in label.split("-"))
            out.append((canon, y, m, d, v))
    return sorted(out)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_melt_matches_direct_computation(spark, data):
    stations = data.draw(st.lists(station, min_size=1, max_size=6))
    n_days = data.draw(st.integers(min_value=1, max_value=5))
    days = [(f"2001-0{1 + i % 9}-1{i}", data.draw(st.lists(value, min_size=len(stations), max_size=len(stations))))
            for i in range(n_days)]
    lines = []
    for i, field in enumerate(META):
        vals = {"code": [s[0] for s in stations], "institution": [s[1] for s in stations],
                "lat": [repr(s[2]) for s in stations], "lon": [repr(s[3]) for s in stations]}.get(
            field, ["x"] * len(stations))
        lines.append(("f", i, ",".join([field] + vals)))
    for k, (label, vals) in enumerate(days):
        lines.append(("f", 100 + k, ",".join([label] + vals)))
    df = spark.createDataFrame(lines, "block string, line_no long, value string")
    got = sorted(tuple(r) for r in daily_from_matrix(df).collect())
    assert got == _expected(stations, days)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_exact_median_matches_statistics_median(spark, data):
    import statistics

    from dryspell.operators.median import exact_median
    groups = data.draw(st.lists(
        st.lists(st.one_of(st.integers(-3, 3).map(float),
                           st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)),
                 min_size=1, max_size=40),
        min_size=1, max_size=4))
    max_ranked = data.draw(st.sampled_from([1, 3, 1000]))
    accuracy = data.draw(st.sampled_from([1, 5, 100, 10000]))
    rows = [(g, v) for g, vals in enumerate(groups) for v in vals]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: r.median for r in exact_median(df, ["g"], "v", max_ranked=max_ranked, accuracy=accuracy).collect()}
    want = {g: statistics.median(vals) for g, vals in enumerate(groups)}
    assert got == want  # exact: both average the two middle values as (a + b) / 2
