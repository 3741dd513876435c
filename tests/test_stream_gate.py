"""STR-1: many keys share a call and a state; each is still judged by itself."""

from attestry.streaming import completeness


def _files(spark, path, *batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "key string, item string, kind string").coalesce(1).write.parquet(f"{path}/p={i}")
    return spark.readStream.schema("key string, item string, kind string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path)


def test_keys_of_one_bucket_stay_apart(spark, tmp_path):
    first = [(f"k{i}", "x", "two") for i in range(300)] + [("u", "x", "none"), (None, "x", "two"), ("k0", "x", "two")]
    second = [(f"k{i}", "y", "two") for i in range(0, 300, 3)] + [("u", "y", "none"), (None, "y", "two")]
    third = [(f"k{i}", "y", "two") for i in range(0, 300, 2)] + [("k0", "z", "two")]
    calls = {}
    for buckets in (1, 7):
        stream = _files(spark, f"{tmp_path}/in{buckets}", first, second, third)
        gate = completeness.completeness_gate(stream, "key", "item", "kind", {"two": 2}, buckets=buckets)
        got = completeness.run_to_end(gate, f"{tmp_path}/out{buckets}", f"{tmp_path}/state{buckets}")
        calls[buckets] = sorted(str((r.key, r.kind, r["items"], r.duplicates)) for r in got.collect())
    want = {i for i in range(300) if i % 3 == 0 or i % 2 == 0}
    assert calls[1] == calls[7] == sorted([str((f"k{i}", "two", "x,y", int(i == 0))) for i in want] + [str((None, "two", "x,y", 0))])
