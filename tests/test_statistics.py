from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chronopix.model import ConfigurationError, Measurement
from chronopix.operators import External, GeometricMedian, Latest, Medoid, NormalisedDifference, Percentile, Simple, SpectralMAD, WaterSummary, reduce_frame
from chronopix.operators.calendar_filters import filter_product, hydrology_windows, hydrology_years, part_name, tide_height_band, tide_low_high, tide_phase
from chronopix.operators.geomedian import weiszfeld
from chronopix.sinks.output import cast_back, file_column, tiff_type, unpivot, writer
from chronopix.sources.catalog import fuse_of
from chronopix.sources.regions import boundary, read_features, read_tiles

AB = [Measurement("a", "float64"), Measurement("b", "float64")]
SCHEMA = "y int, x int, time timestamp_ntz, ord bigint, source tinyint, a double, b double"


def frame(spark, series):
    """series: pixel -> [(a, b)]."""
    rows = [(p, 0, dt.datetime(2000, 1, 1) + dt.timedelta(days=i), i, i % 3, a, b) for p, obs in series.items() for i, (a, b) in enumerate(obs)]
    return spark.createDataFrame(rows, SCHEMA)


def one(spark, series, stat, inputs=AB):
    return {r["y"]: r for r in reduce_frame(frame(spark, series), ("y", "x"), [("", stat, inputs)]).collect()}


CASES = {
    0: [(None, None)] * 3,
    1: [(5.0, 1.0)],
    2: [(1.0, 2.0), (3.0, None), (2.0, 2.0), (2.0, 7.0)],
    3: [(10.0, 1.0), (20.0, 1.0), (30.0, 1.0), (40.0, 1.0)],
    4: [(10.0, 0.0), (20.0, 0.0), (30.0, 0.0), (40.0, 0.0), (50.0, 0.0), (60.0, 0.0)],
    5: [(10.0, None), (None, None), (30.0, None)],
}


def nearest(values, q):
    v = np.sort([x for x in values if x is not None])
    return None if not len(v) else v[int(np.rint(q / 100 * (len(v) - 1)))]


@pytest.mark.parametrize("q", [0, 10, 50, 90, 100])
def test_percentile_is_the_nearest_index(spark, q):
    got = one(spark, CASES, Percentile(q))
    for p, obs in CASES.items():
        for i, b in enumerate("ab"):
            assert got[p][f"{b}_PC_{q}"] == nearest([o[i] for o in obs], q)
    assert q != 50 or (got[3]["a_PC_50"], got[4]["a_PC_50"], got[5]["a_PC_50"]) == (30.0, 30.0, 10.0)


def test_percentile_minimum(spark):
    got = one(spark, CASES, Percentile(50, minimum_valid_observations=4))
    assert got[2]["a_PC_50"] is None and got[3]["a_PC_50"] == 30.0 and got[0]["a_PC_50"] is None and got[5]["a_PC_50"] == 10.0  # no complete observation at all: left alone


@pytest.mark.parametrize("name,f", [("mean", np.mean), ("median", np.median), ("min", np.min), ("max", np.max), ("sum", np.sum), ("prod", np.prod), ("std", np.std), ("var", np.var), ("count", len)])
def test_simple_reductions(spark, name, f):
    got = one(spark, CASES, Simple(name))
    for p, obs in CASES.items():
        v = [o[0] for o in obs if o[0] is not None]
        want = f(v) if v else {"sum": 0, "prod": 1, "count": 0}.get(name)
        assert got[p]["a"] == (want if want is None else pytest.approx(float(want), rel=1e-12))


def test_arg_positions_count_missing_times(spark):
    got = one(spark, {0: [(None, 1.0), (3.0, 1.0), (1.0, 0.0), (1.0, 0.0)], 1: [(None, None)]}, Simple("argmin"))
    assert got[0]["a"] == 2 and got[0]["b"] == 2 and got[1]["a"] is None


def brute_medoid(obs):
    whole = [o for o in obs if None not in o]
    if not whole:
        return None
    d = [round(sum(math.dist(o, p) for p in whole), 9) for o in whole]
    return whole[d.index(min(d))]


def test_medoid(spark):
    got = one(spark, CASES | {6: [(0.0, 0.0), (1.0, 0.0), (10.0, 0.0)]}, Medoid())
    for p, obs in CASES.items():
        want = brute_medoid(obs)
        assert (got[p]["a"], got[p]["b"]) == (want or (None, None))
    assert got[6]["a"] == 1.0 and got[6]["observed"] == (dt.date(2000, 1, 2) - dt.date(1970, 1, 1)).days


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.none() | st.integers(-50, 50).map(float), st.none() | st.integers(-50, 50).map(float)), min_size=1, max_size=12), min_size=1, max_size=20))
def test_rows_in_any_order_and_partitioning_give_the_same(spark, series):
    df = frame(spark, dict(enumerate(series)))
    stats = [("m_", Medoid(), AB), ("p_", Percentile([25, 75], per_pixel_metadata=["source", "observed_date"]), AB), ("l_", Latest(), AB), ("s_", Simple("max"), AB)]
    a = sorted(map(tuple, reduce_frame(df, ("y", "x"), stats).collect()), key=repr)
    b = sorted(map(tuple, reduce_frame(df.orderBy("a", "b").repartition(5), ("y", "x"), stats).collect()), key=repr)
    assert a == b
    for y, obs in enumerate(series):
        row = next(r for r in a if r[0] == y)
        assert row[2:4] == (brute_medoid(obs) or (None, None))


def test_geometric_median_properties(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 9, 3))
    valid = rng.random((40, 9)) < 0.8
    valid[:, 0] = True
    m = weiszfeld(x, valid, 1e-12)
    shift = np.array([3.0, -1.0, 0.5])
    assert np.allclose(weiszfeld(x + shift, valid, 1e-12), m + shift, atol=1e-6)
    for i in range(40):
        own = x[i][valid[i]]
        cost = lambda p, own=own: np.sqrt(((own - p) ** 2).sum(axis=1)).sum()
        assert cost(m[i]) <= min(cost(o) for o in own) + 1e-6 and all(cost(m[i]) <= cost(m[i] + e) + 1e-9 for e in 1e-3 * rng.normal(size=(20, 3)))
    got = one(spark, {0: [(3.0, 3.0), (1.0, 1.0), (2.0, 2.0)], 1: [(None, 1.0)], 2: [(0.0, 0.0)] * 3, 3: [(1.0, 5.0)]}, GeometricMedian(1e-10))
    assert got[0]["a"] == pytest.approx(got[0]["b"]) and got[0]["a"] == pytest.approx(2.0, abs=1e-5)
    assert got[1]["a"] is None and got[2]["a"] is None and (got[3]["a"], got[3]["b"]) == (1.0, 5.0)


def test_weiszfeld_is_least():
    rng = np.random.default_rng(5)
    for n, time, bands in ((400, 4, 2), (400, 5, 3), (40, 30, 6)):
        x, valid = rng.integers(0, 50, (n, time, bands)).astype(float), rng.random((n, time)) < 0.9
        m, some = weiszfeld(x, valid, 1e-9), valid.any(axis=1)

        def away(c, x=x, valid=valid, some=some):
            return np.where(valid, np.sqrt(((x - c[:, None]) ** 2).sum(axis=2)), 0).sum(axis=1)[some]

        least = away(m)
        for i in range(time):
            at = np.where(valid[:, i, None], x[:, i], m)
            assert (least <= away(at) + 1e-9).all()
        for scale in (1e-3, 1e-1, 10):
            assert (least <= away(m + rng.normal(0, scale, m.shape)) + 1e-9).all()


def test_spectral_mad(spark):
    got = one(spark, {0: [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], 1: [(None, None)], 2: [(1.0, 0.0), (0.0, 1.0), (1.0, 1.0)]}, SpectralMAD(1e-10))
    assert got[0]["smad"] == pytest.approx(0, abs=1e-9) and got[1]["smad"] is None and got[2]["smad"] > 0


def test_normalised_difference_clamps_after_the_reduction(spark):
    series = {0: [(1.0, 1.0), (3.0, 1.0)], 1: [(1.0, -1.0), (1.0, 1.0)], 2: [(0.0, 0.0)], 3: [(3.0, -1.0)]}
    got = one(spark, series, NormalisedDifference("a", "b", "nd", ["min", "max", "mean"]))
    assert got[0]["nd_mean"] == 0.25 and got[1]["nd_max"] is None and got[1]["nd_min"] == 0.0 and got[2]["nd_min"] is None and got[3]["nd_max"] is None
    with pytest.raises(ConfigurationError):
        NormalisedDifference("a", "z", "nd").measurements(AB)


def test_water_needs_integers_and_gives_missing_without_clear(spark):
    with pytest.raises(ConfigurationError):
        WaterSummary().measurements([Measurement("w", "float32")])
    df = spark.createDataFrame([(0, 0, w) for w in (128, 132, 0, 4, 64)] + [(1, 0, 64)], "y int, x int, w int")
    got = {r["y"]: r for r in reduce_frame(df, ("y", "x"), [("", WaterSummary(), [Measurement("w", "uint8")])]).collect()}
    assert (got[0]["count_wet"], got[0]["count_clear"], got[0]["frequency"]) == (2, 4, 0.5) and got[1]["frequency"] is None


def test_external_and_fuse_names():
    assert External("chronopix.contrib.CountWet").measurements([])[0].name == "wet"
    for bad in ("nothing", "chronopix.contrib.Nope", "chronopix.model.Epoch"):
        with pytest.raises(ConfigurationError):
            External(bad)
    with pytest.raises(ConfigurationError):
        fuse_of("nope")


def test_cast_back_truncates_and_fills(spark):
    df = spark.createDataFrame([(1, -1.7, None, 300.0), (2, float("nan"), 2.5, 1e9)], "k int, a double, b double, c double")
    out = cast_back(df, ["k"], [Measurement("a", "int16", -1), Measurement("b", "float32"), Measurement("c", "int16", -999)])
    rows = {r["k"]: r for r in out.collect()}
    assert rows[1]["a"] == -1 and rows[2]["a"] == -1 and math.isnan(rows[1]["b"]) and rows[1]["c"] == 300 and rows[2]["c"] == -999
    assert out.schema["a"].metadata["nodata"] == -1
    with pytest.raises(ConfigurationError):
        cast_back(df, ["k"], [Measurement("zz")])


def test_writers(spark, tmp_path):
    from chronopix.model import OutputProduct

    df = spark.createDataFrame([(1, 0, 2.0, None)], "k int, epoch_id int, a double, b double")
    p = OutputProduct("out", Simple(), tuple(AB), (Measurement("a", "int16", -1), Measurement("b", "int16", -1)))
    w = writer("Par quet")(str(tmp_path))
    path = w.write(df, p, ["k", "epoch_id"])
    assert spark.read.parquet(path).first()["b"] == -1
    with pytest.raises(Exception, match="(?i)exists"):
        w.write(df, p, ["k", "epoch_id"])
    assert spark.read.parquet(writer("bands")(str(tmp_path / "b")).write(df, p, ["k", "epoch_id"])).count() == 2
    assert writer("frame")().write(df, p, ["k"]).first()["a"] == 2
    with pytest.raises(ConfigurationError):
        writer("envi")
    with pytest.raises(ConfigurationError):
        unpivot(df, ["k"], [Measurement("a", "int16", -1), Measurement("b", "int8", 0)])
    assert tiff_type("int8", -1) == ("uint8", 255)


def test_file_names(spark):
    from chronopix.model import OutputProduct

    a, e = dt.datetime(2001, 2, 3), dt.datetime(2001, 12, 31, 23, 59, 59, 999999)
    df = spark.createDataFrame([(1, -2, a, e)], "tile_x int, tile_y int, epoch_start timestamp_ntz, epoch_end timestamp_ntz")
    product = lambda t: OutputProduct("n", Simple(), tuple(AB), tuple(AB), "s", t, {}, {"extra": 7})
    for template in ("{name}/{x}_{y}_{epoch_start:%Y%m}_{extra}.nc", "{stat_name}{x}{y}_{epoch_start}_{epoch_end}", "{epoch_end:%d-%m-%y %H:%M:%S.%f %j}"):
        want = template.format(name="n", stat_name="s", x=1, y=-2, epoch_start=a, epoch_end=e, extra=7)
        assert df.select(file_column(product(template), df.columns)).first()[0] == want
    for bad in ("{nope}", "{var_name}", "{feature_id}", "{epoch_start:%Q}"):
        with pytest.raises(ConfigurationError):
            file_column(product(bad), df.columns)
    f = {"feature_id": 3, "properties": {"lon": 1.5, "lat": -2, "DY1": "1995", "DY2": "1998"}}
    assert part_name(f, {"method": "by_tide_height", "args": {"tide_percent": 10, "sub_class": "e"}}) == ("E_1.5", "-2")
    assert part_name(f, {"method": "by_tide_height", "args": {"tide_percent": 10}}) == ("3_1.5", "-2_PER_10")
    assert part_name(f, {"method": "by_hydrological_months", "args": {"type": "dry"}}) == ("3", "1995_1998")


def test_regions(tmp_path):
    f = read_features('{"type":"FeatureCollection","features":[{"properties":{"ID":4},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}},{"properties":{},"id":9,"geometry":{"type":"Polygon","coordinates":[[[5,5],[6,5],[6,6],[5,5]]]}}]}')
    assert [x["feature_id"] for x in f] == [4, 9] and boundary(f)[0] == (0.0, 0.0)
    (tmp_path / "t").write_text("1 2\n3 4\n")
    assert read_tiles(path=str(tmp_path / "t")) == [(1, 2), (3, 4)]
    with pytest.raises(ConfigurationError):
        read_tiles((1, 2), "t")


def test_calendars(spark):
    assert hydrology_years({"DY1": "1995", "aDYb": 1999, "WY": "2000"}, "dry") == [1995, 1999]
    w = hydrology_windows([1995], ["07", "02"])
    assert w[0].end.day == 29 and w[0].start == dt.datetime(1996, 7, 1)
    assert hydrology_windows([1995])[0].end.date() == dt.date(1996, 11, 30)
    tides = spark.createDataFrame([(dt.datetime(2000, 1, 1, h), float(h)) for h in range(11)], "time timestamp_ntz, height double")
    assert sorted(r["height"] for r in tide_height_band(tides, 10, 10).collect()) == [0.0, 1.0]
    assert sorted(r["height"] for r in tide_height_band(tides, 10, 90).collect()) == [8.0, 9.0, 10.0]
    assert {(r["height"], r["kind"]) for r in tide_low_high(tides, 50).collect()} == {(h, "low") for h in (0.0, 1.0, 2.0)} | {(h, "high") for h in (8.0, 9.0, 10.0)}
    phases = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 1.0, 2.0), (1.0, 2.0, 3.0), (3.0, 2.0, 1.0)], "height_before double, height double, height_after double")
    assert [r["phase"] for r in tide_phase(phases).collect()] == ["ph", "pl", "f", "e"]
    with pytest.raises(ValueError):
        filter_product(tides, {"method": "nope"}, {})


def test_stream_and_table_agree(spark, sf, tmp_path):
    from pyspark.sql import functions as F

    from chronopix.streaming.incremental import run_to_table, stream_reduce

    m = [Measurement("value", "float64")]
    src = spark.read.parquet(f"{sf}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("time"), "value", F.col("event_id").alias("ord"))
    src.repartition(3).write.parquet(str(tmp_path / "in"))
    stats = [("n_", Simple("count"), m), ("max_", Simple("max"), m), ("last_", Latest(), m)]
    stream = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run_to_table(stream_reduce(stream, ["user_id"], stats, "7 days", late="60 days"), "streamed", str(tmp_path / "ck")).awaitTermination(60)
    want = sorted(map(tuple, stream_reduce(src, ["user_id"], stats, "7 days").collect()))
    assert sorted(map(tuple, spark.table("streamed").collect())) == want
    with pytest.raises(ConfigurationError):
        stream_reduce(src, ["user_id"], [("", Simple("median"), m)], "1 day")
