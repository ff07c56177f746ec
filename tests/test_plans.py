from __future__ import annotations

import datetime as dt

import pytest
from dateutil.relativedelta import relativedelta
from hypothesis import given, settings
from hypothesis import strategies as st

from chronopix.functions.flags import WATER_FLAGS, compile_flags
from chronopix.functions.geometry import GeoBox, GridSpec, hull
from chronopix.functions.scalars import format_bytes, format_seconds, product
from chronopix.model import ConfigurationError, Epoch
from chronopix.plans import config as C
from chronopix.plans.epochs import as_time, assign, date_sequence, epochs_of, for_year, intersect, parse_duration

D = dt.datetime


def test_yearly_epochs():
    e = date_sequence(D(2000, 1, 1), D(2016, 1, 1), "1y", "1y")
    assert len(e) == 16 and e[0].end == D(2000, 12, 31, 23, 59, 59, 999999)


def test_seasonal_epochs():
    e = date_sequence(D(2000, 6, 1), D(2016, 9, 1), "3m", "1y")
    assert len(e) == 17 and (e[-1].start, e[-1].end) == (D(2016, 6, 1), D(2016, 8, 31, 23, 59, 59, 999999))


def test_overlapping_epochs():
    e = date_sequence(D(2013, 9, 1), D(2017, 1, 1), "16m", "12m")
    assert [x.start.year for x in e] == [2013, 2014, 2015] and e[-1].end == D(2016, 12, 31, 23, 59, 59, 999999)


def test_starts_at_month_ends_are_left_out_not_moved():
    assert [e.start for e in date_sequence(D(2000, 1, 31), D(2000, 6, 30), "1d", "1m")] == [D(2000, 1, 31), D(2000, 3, 31), D(2000, 5, 31)]


@settings(max_examples=200, deadline=None)
@given(st.datetimes(D(1970, 1, 1), D(2050, 1, 1)), st.integers(1, 60), st.sampled_from("ymd"), st.integers(1, 60), st.sampled_from("ymd"))
def test_epochs_have_their_length_and_end_in_time(start, n, unit, k, step):
    end = start + relativedelta(years=20)
    for e in date_sequence(start, end, f"{n}{unit}", f"{k}{step}")[:50]:
        assert e.start < e.end <= end
        assert e.end + dt.timedelta(microseconds=1) == e.start + parse_duration(f"{n}{unit}")


@pytest.mark.parametrize("bad", ["3", "m", "3w", "-1d", ""])
def test_bad_durations(bad):
    with pytest.raises(ValueError):
        parse_duration(bad)


def test_source_windows():
    year = Epoch(D(2017, 1, 1), D(2017, 12, 31))
    assert intersect(("2010-01-01", "2017-03-03"), year) == Epoch(D(2017, 1, 1), D(2017, 3, 3))
    assert intersect(("2010-01-01", "2017-01-01"), year) == Epoch(D(2017, 1, 1), D(2017, 1, 1))
    assert intersect(("2010-01-01", "2016-12-31"), year) is None
    assert intersect(None, year) is year


def test_single_range_keeps_its_end_and_year_overrides():
    assert epochs_of({"start_date": "2000-01-01", "end_date": "2001-01-01"}) == [Epoch(D(2000, 1, 1), D(2001, 1, 1))]
    assert as_time(for_year({"start_date": "x", "end_date": "y"}, 1999)["start_date"]) == D(1999, 1, 1)
    with pytest.raises(ConfigurationError):
        epochs_of({"start_date": "2000-01-01", "end_date": "2001-01-01", "step_size": "1y"})


def test_epoch_bounds_are_inclusive_to_the_microsecond(spark):
    at = [D(2000, 12, 31, 23, 59, 59, 999999), D(2001, 1, 1), D(2001, 12, 31, 23, 59, 59, 999999), D(2002, 1, 1)]
    df = spark.createDataFrame([(t,) for t in at], "time timestamp_ntz")
    got = assign(df, date_sequence(D(2000, 1, 1), D(2002, 1, 1), "1y", "1y"))
    assert sorted((r["time"], r["epoch_id"]) for r in got.collect()) == [(at[0], 0), (at[1], 1), (at[2], 1)]
    assert assign(df, []).count() == 0


def test_overlapping_epochs_take_an_observation_twice(spark):
    df = spark.createDataFrame([(D(2001, 3, 1),)], "time timestamp_ntz")
    assert assign(df, date_sequence(D(2000, 1, 1), D(2003, 1, 1), "18m", "1y")).count() == 2


def test_flags():
    assert compile_flags(WATER_FLAGS, wet=True) == (251, 128)
    assert compile_flags(WATER_FLAGS, dry=True) == (251, 0)
    assert compile_flags(WATER_FLAGS, cloud=True, sea=False) == (68, 64)
    with pytest.raises(ConfigurationError):
        compile_flags(WATER_FLAGS, frost=True)


def test_geometry():
    assert hull([(0, 0), (2, 0), (1, 1), (2, 2), (0, 2), (1, 0)]) == [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
    assert len(GridSpec("EPSG:4326", (1.0, 1.0), (0.1, 0.1)).cells([(100, -50), (150, -50), (150, -40), (100, -40)])) == 500
    box = GeoBox.around("EPSG:4326", (137, 138.5), (-41, -42), (0.1, -0.1))
    assert (box.width, box.height) == (15, 10)


def test_small_helpers():
    assert product([2, 3, 4]) == 24 and product([]) == 1
    assert format_bytes(2048) == "2.0 KB" and format_seconds(3661) == "1:01:01.0"


BASE = {
    "sources": [{"product": "p", "measurements": ["red"]}],
    "date_ranges": {"start_date": "2000-01-01", "end_date": "2001-01-01"},
    "output_products": [{"name": "a", "statistic": "simple"}],
}


@pytest.mark.parametrize(
    "change",
    [
        {"surprise": 1}, {"sources": []}, {"output_products": [{"name": "a", "statistic": "nonsense"}]}, {"output_products": [{"name": "a", "statistic": "simple"}] * 2},
        {"sources": [{"product": "p", "measurements": ["red"]}, {"product": "q", "measurements": ["blue"]}]}, {"sources": [{"product": "p"}]}, {"date_ranges": {"start_date": "2000-01-01"}},
        {"output_products": [{"name": "a", "statistic": "simple", "file_path_template": "{wrong}.tif"}]},
    ],
)
def test_bad_configurations(change):
    with pytest.raises(ConfigurationError):
        C.validate({**BASE, **change})


def test_good_configuration_and_overrides():
    C.validate({**BASE, "output_products": [{"name": "a", "statistic": "simple", "file_path_template": "{x}_{y}_{epoch_start:%Y-%m-%d}_{epoch_end}_{name}_{stat_name}_{feature_id}_{var_name}"}]})
    out = C.normalise(BASE, tiles=[(1, 2)], location="/x", year=2003)
    assert out["input_region"] == {"tiles": [[1, 2]]} and out["location"] == "/x" and out["date_ranges"]["start_date"] == D(2003, 1, 1)
    assert C.normalise({**BASE, "input_region": {"from_file": "f"}}, tiles=[(1, 2)])["input_region"] == {"from_file": "f"}
    assert C.read("a: 1\n---\na: 2\n") == {"a": 1}
