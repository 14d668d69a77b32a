"""The spatial grid never separates two points within the radius, including
high latitudes, the poles and the antimeridian; tasks carry the
package's functions by value."""

from __future__ import annotations

import math
import random
import subprocess
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from citystream.operators.bunching import Grid
from citystream.operators import timer
from citystream.session import ship_package
from models import haversine_m


def test_close_points_share_or_neighbour_a_cell(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(4000):
        lat = rnd.choice([rnd.uniform(-89.99, 89.99), rnd.uniform(79, 89.99), rnd.uniform(-89.99, -79), 0.0])
        lon = rnd.choice([rnd.uniform(-180, 180), 179.9999, -179.9999])
        # A second point at most ~250 m away in a random direction.
        d = rnd.uniform(0, 250) / 6_371_000
        brg = rnd.uniform(0, 2 * math.pi)
        p1, l1 = math.radians(lat), math.radians(lon)
        p2 = math.asin(math.sin(p1) * math.cos(d) + math.cos(p1) * math.sin(d) * math.cos(brg))
        l2 = l1 + math.atan2(math.sin(brg) * math.sin(d) * math.cos(p1), math.cos(d) - math.sin(p1) * math.sin(p2))
        lat2, lon2 = math.degrees(p2), (math.degrees(l2) + 540) % 360 - 180
        rows.append((lat, lon, lat2, lon2, haversine_m(lat, lon, lat2, lon2)))
    df = spark.createDataFrame(rows, "lat double, lon double, lat2 double, lon2 double, dist double")
    g = Grid(200.0)
    checked = df.where("dist <= 200").select(
        F.array_contains(g.neighbour_cells(F.col("lat"), F.col("lon")),
                         g.own_cell(F.col("lat2"), F.col("lon2"))).alias("ok"))
    assert checked.count() > 1000
    assert checked.where(~F.col("ok")).count() == 0


def test_tasks_need_no_package_on_the_workers(spark):
    ship_package()
    code = cloudpickle.dumps(timer.resolve)
    probe = ("import pickle, sys; f = pickle.loads(sys.stdin.buffer.read()); "
             "assert 'citystream' not in sys.modules; print(f.__name__)")
    out = subprocess.run([sys.executable, "-c", probe], input=code, capture_output=True, cwd="/")
    assert out.stdout.split()[-1] == b"resolve", out.stderr
