import random

import pytest
from conftest import plan_of, values

from fleetgauge.operators import geo

ZONE = "zone_id STRING, min_lat DOUBLE, max_lat DOUBLE, min_lon DOUBLE, max_lon DOUBLE"


@pytest.fixture
def case(frame):
    rng = random.Random(3)
    points = [(i, round(rng.uniform(-90, 90), 2), round(rng.uniform(-180, 180), 2)) for i in range(300)]
    points += [(300, 12.5, 77.2), (301, 12.8, 77.5), (302, 12.81, 77.5), (303, None, 77.3),
               (304, float("nan"), 77.3), (305, 1e9, 5.0)]
    zones = [("box", 12.5, 12.8, 77.2, 77.5), ("again", 12.5, 12.8, 77.2, 77.5),
             ("world", -90.0, 90.0, -180.0, 180.0), ("beyond", -1e12, 1e12, 0.0, 10.0),
             ("point", points[5][1], points[5][1], points[5][2], points[5][2]),
             ("inverted", 5.0, 1.0, 0.0, 9.0), ("nothing", None, 1.0, 0.0, 9.0)]
    for i in range(60):
        lat, lon = rng.uniform(-90, 80), rng.uniform(-180, 160)
        zones.append((f"z{i}", lat, lat + rng.uniform(0, 20), lon, lon + rng.uniform(0, 40)))
    expected = [(i, z) for i, lat, lon in points for z, a, b, c, d in zones
                if None not in (lat, lon, a) and a <= lat <= b and c <= lon <= d]
    return frame("id INT, lat DOUBLE, lon DOUBLE", points), frame(ZONE, zones), expected


@pytest.mark.parametrize("broadcast_cells", [geo.BROADCAST_CELLS, 0])
def test_join_and_flag_match_brute_force(case, monkeypatch, broadcast_cells):
    monkeypatch.setattr(geo, "BROADCAST_CELLS", broadcast_cells)
    points, zones, expected = case
    joined, flagged = geo.match_zones(points, zones), geo.flag_zones(points, zones)
    assert sorted(values(joined, "id", "zone_id")) == sorted(expected)
    hit = {i for i, _ in expected}
    assert sorted(values(flagged, "id", "restricted_zone_flag")) == [
        (i, int(i in hit)) for i in range(306)]
    for df in (joined, flagged):
        plan = plan_of(df)
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert ("SortMergeJoin" in plan) == (broadcast_cells == 0)


def test_cells_per_zone_are_bounded(case):
    _, zones, _ = case
    cells = geo._zone_cells(zones, geo.FINE_DEGREES, geo.COARSE_DEGREES, geo.MAX_CELLS)
    widest = (2 * geo.CLAMP_DEGREES / geo.COARSE_DEGREES + 1) ** 2
    assert max(r["count"] for r in cells.groupBy("zone_id").count().collect()) <= widest
