"""STR-3 between streams: two watermarks, late rows, state that goes, and the remainder."""

import datetime as dt

import pytest

from attestry.streaming import completeness

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "k string, ts timestamp, v string"


class Files:
    """A folder that a file stream reads, one file a batch."""

    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, str(path), 0
        path.mkdir()

    def add(self, *rows):
        self.n += 1
        df = self.spark.createDataFrame([(k, T0 + dt.timedelta(minutes=m), v) for k, m, v in rows], SCHEMA)
        df.coalesce(1).write.parquet(f"{self.path}/{self.n:03}")

    def stream(self, name):
        return self.spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(self.path).withColumnRenamed("v", name)


@pytest.fixture
def sides(spark, tmp_path):
    return Files(spark, tmp_path / "left"), Files(spark, tmp_path / "right")


def run(spark, sides, tmp_path, how):
    both = completeness.keyed_join(sides[0].stream("a"), sides[1].stream("b"), "k", "ts", "10 minutes", how, ("5 minutes", "20 minutes"))
    out = completeness.run_to_end(both.select("a", "b"), f"file://{tmp_path}/out-{how}", f"file://{tmp_path}/marks-{how}")
    return sorted(((r.a, r.b) for r in out.collect()), key=str)


@pytest.mark.parametrize("how", ["inner", "left_outer", "full_outer"])
def test_pairs_then_remainder(spark, sides, tmp_path, how):
    left, right = sides
    left.add(("x", 0, "x0"), ("y", 0, "y0"), ("z", 50, "z50"))
    right.add(("x", 9, "X9"), ("y", 11, "Y11"), ("w", 0, "W0"))
    got = run(spark, sides, tmp_path, how)
    assert ("x0", "X9") in got and not any(None in r for r in got)  # nothing has been passed yet
    # the slower side's watermark goes to 60: what can have no partner any more leaves
    left.add(("q", 200, "q200"))
    right.add(("q", 80, "Q80"))
    rest = {"inner": [], "left_outer": [("y0", None)], "full_outer": [("y0", None), (None, "W0"), (None, "Y11")]}[how]
    want = [("x0", "X9"), *rest]
    assert run(spark, sides, tmp_path, how) == sorted(want, key=str)
    # rows later than the watermark are dropped on both sides, rows within it still meet
    left.add(("y", 1, "late"), ("z", 75, "z75"))
    right.add(("z", 70, "Z70"), ("x", 2, "LATE"))
    got = run(spark, sides, tmp_path, how)
    assert ("z75", "Z70") in got and not any(v in ("late", "LATE") for r in got for v in r)
    # each row of the remainder leaves once
    left.add(("e", 500, "e"))
    right.add(("e", 700, "E"))
    got = run(spark, sides, tmp_path, how)
    assert len(got) == len(set(got))
    if how != "inner":
        assert ("z50", None) in got and ("q200", None) in got and ("e", None) not in got
    if how == "full_outer":
        assert (None, "Q80") in got and (None, "E") not in got


def test_finished_inputs(spark):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    a = spark.createDataFrame([("x", at(0), "a"), (None, at(0), "n"), ("y", at(0), "c")], "k string, ts timestamp, a string")
    b = spark.createDataFrame([("x", at(10), "b"), ("x", at(11), "far"), (None, at(0), "m")], "k string, ts timestamp, b string")
    got = {(r.a, r.b) for r in completeness.keyed_join(a, b, "k", "ts", "10 minutes", "full_outer").collect()}
    assert got == {("a", "b"), ("n", None), ("c", None), (None, "far"), (None, "m")}
