"""NRM-1 (F4): ids are numbered in ranges whose bounds come from the whole table."""

from pyspark.sql import functions as F

from attestry.operators import normalize


def test_ranges_share_a_sorted_table(spark, monkeypatch):
    held = []
    keep = normalize.stored
    monkeypatch.setattr(normalize, "stored", lambda df: held.append(keep(df)) or held[-1])
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, "a").when(F.col("id") % 20 < 19, "b").alias("s"), F.col("id").alias("o"), F.lit("x").alias("other"))
    got = {r.o: r.sequence_id for r in normalize.assign_ids(df, "s", ["o"]).collect()}
    numbers = {"a": 0, "b": 0}
    for o in range(20_000):
        s = "a" if o % 10 < 9 else "b" if o % 20 < 19 else None
        if s:
            numbers[s] += 1
        assert got[o] == (s and f"{s}__c{numbers[s]:06d}"), o  # a row without a sample stays, as the SQL has it
    sizes = [r["count"] for r in held[0].groupBy(F.shiftright("__at", 33)).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 8_000
    assert normalize.assign_ids(df.limit(0), "s", ["o"]).count() == 0
