import math
import random

import pytest

from seriesloom import slice_intervals, volume_geometry_index
from seriesloom.lookups import CT_CLASS, SEG_CLASS

from .support import by, instances

AXIAL = ["1", "0", "0", "0", "1", "0"]
TILTED = ["1", "0", "0", "0", "0.8", "0.6"]
FLAGS = (
    "single_orientation",
    "orthogonal_orientation",
    "unique_slice_positions",
    "consistent_in_plane_row",
    "consistent_in_plane_col",
    "consistent_pixel_spacing",
    "consistent_image_dimensions",
    "uniform_slice_spacing",
)


def slices(name, zs, **more):
    base = {
        "SeriesInstanceUID": name,
        "SOPClassUID": CT_CLASS,
        "ImageOrientationPatient": AXIAL,
        "PixelSpacing": ["0.5", "0.5"],
        "Rows": 512,
        "Columns": 512,
    }
    out = []
    for i, z in enumerate(zs):
        r = {**base, "SOPInstanceUID": f"{name}.{i}", "ImagePositionPatient": ["0", "0", str(z)]}
        r.update({k: v(i) if callable(v) else v for k, v in more.items()})
        out.append(r)
    return out


def failing(row):
    return {f for f in FLAGS if row[f] is not True}


CASES = {
    "regular": (slices("regular", [0, 2.5, 5, 7.5]), set()),
    "gap": (slices("gap", [0, 2.5, 7.5, 10]), {"uniform_slice_spacing"}),
    "duplicate": (
        slices("duplicate", [0, 2.5, 2.5, 5]),
        {"unique_slice_positions", "uniform_slice_spacing"},
    ),
    "shifted_row": (
        slices("shifted_row", [0, 1, 2], ImagePositionPatient=lambda i: [str(i), "0", str(i)]),
        {"consistent_in_plane_row"},
    ),
    "shifted_col": (
        slices("shifted_col", [0, 1, 2], ImagePositionPatient=lambda i: ["0", str(i), str(i)]),
        {"consistent_in_plane_col"},
    ),
    "spacing": (
        slices("spacing", [0, 1, 2], PixelSpacing=lambda i: ["0.5", "0.5" if i else "0.6"]),
        {"consistent_pixel_spacing"},
    ),
    "matrix": (
        slices("matrix", [0, 1, 2], Rows=lambda i: 512 if i else 256),
        {"consistent_image_dimensions"},
    ),
    "no_matrix": (
        slices("no_matrix", [0, 1, 2], Columns=None),
        {"consistent_image_dimensions"},
    ),
    "not_orthogonal": (
        slices("not_orthogonal", [0, 1, 2], ImageOrientationPatient=["1", "0", "0", "0.5", "0.5", "0"]),
        {"orthogonal_orientation"},
    ),
}


@pytest.fixture(scope="module")
def results(spark):
    rows = [r for rs, _ in CASES.values() for r in rs]
    rows += slices("single", [4])
    rows += slices("tilted", [0, 2, 4], ImageOrientationPatient=TILTED,
                   ImagePositionPatient=lambda i: ["0", str(-0.6 * 2 * i), str(0.8 * 2 * i)])
    rows += slices("missing_one", [0, 1, 2],
                   ImagePositionPatient=lambda i: ["0", "0", str(i)] if i else [])
    rows += slices("no_orientation", [0, 1], ImageOrientationPatient=[])
    rows += slices("short_orientation", [0, 1], ImageOrientationPatient=["1", "0", "0", "0"])
    rows += slices("mixed", [0, 1, 2], ImageOrientationPatient=lambda i: TILTED if i == 2 else AXIAL)
    rows += slices("scout", [0, 1, 2], ImageType=lambda i: ["ORIGINAL", "LOCALIZER"] if i == 1 else [])
    rows += slices("mip", [0, 1, 2], ImageType=lambda i: ["DERIVED", "XMIPX"] if i == 1 else [])
    rows += slices("other", [0, 1], SOPClassUID=SEG_CLASS)
    rows += slices("by_other", [0, 1, 2])
    rows += slices("by_other", [9], SOPClassUID=SEG_CLASS, ImageType=["LOCALIZER"],
                   SOPInstanceUID="by_other.x")
    return by(volume_geometry_index(instances(spark, rows)), "SeriesInstanceUID")


@pytest.mark.parametrize("name", CASES)
def test_each_flag_alone(results, name):
    got, expected = results[name], CASES[name][1]
    assert failing(got) == expected
    assert got.regularly_spaced_3d_volume is (not expected)
    assert got.obliquity_degrees == 0.0


def test_single_slice_is_undecided(results):
    got = results["single"]
    assert got.uniform_slice_spacing is None and got.regularly_spaced_3d_volume is None


def test_tilt_is_measured_and_regular(results):
    got = results["tilted"]
    assert got.obliquity_degrees == round(math.degrees(math.acos(0.8)), 2)
    assert got.regularly_spaced_3d_volume is True


def test_missing_position(results):
    got = results["missing_one"]
    # two positions for three slices, and the expected spacing is off by a half
    assert got.unique_slice_positions is False and got.uniform_slice_spacing is False


def test_missing_orientation(results):
    got = results["no_orientation"]
    assert got.single_orientation is True and got.orthogonal_orientation is None
    assert got.unique_slice_positions is False and got.obliquity_degrees is None
    assert results["short_orientation"].orthogonal_orientation is None


def test_mixed_orientation(results):
    assert results["mixed"].single_orientation is False


def test_overview_series_are_left_out(results):
    assert {"scout", "mip", "other", "by_other"} & set(results) == set()


def test_hot_series_matches_brute_force(spark):
    """One series holds most rows, so it is cut into many fragments."""
    rng = random.Random(3)
    tables = {"hot": [rng.choice(range(4000)) * 0.5 for _ in range(3000)]}
    tables["even"] = [i * 1.25 for i in range(1500)]
    tables["almost"] = [i * 1.25 for i in range(700)] + [700 * 1.25 + 0.1]
    for k in range(40):
        tables[f"s{k}"] = [rng.choice(range(6)) * 2.0 for _ in range(rng.randint(1, 6))]
    rows = [r for name, zs in tables.items() for r in slices(name, zs)]
    df = instances(spark, rows).repartition(6).cache()
    got = by(volume_geometry_index(df), "SeriesInstanceUID")
    led = slice_intervals(df).collect()
    for name, zs in tables.items():
        order = sorted(zs)
        gaps = [b - a for a, b in zip(order, order[1:])]
        unique = len(set(zs)) == len(zs)
        assert got[name].unique_slice_positions is unique
        if gaps:
            want = (order[-1] - order[0]) / len(gaps)
            uniform = max(abs(g - want) for g in gaps) < 0.01 * abs(want)
            assert got[name].uniform_slice_spacing is uniform
        mine = sorted(
            (r.slice_position, r.slice_interval) for r in led
            if r.SeriesInstanceUID == name and r.slice_interval is not None
        )
        assert sorted(g for _, g in mine) == sorted(gaps)
        assert sum(r.SeriesInstanceUID == name for r in led) == len(zs)
    df.unpersist()
