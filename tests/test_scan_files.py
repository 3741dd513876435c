"""Files that a scan writes and reads again."""

from attestry.plans import records


def test_no_file_of_a_scan_holds_more_than_its_rows(spark, monkeypatch):
    """All rows of a kind were one file, written and, if compressed, read by one task."""
    monkeypatch.setattr(records, "FILE_ROWS", 900)
    folders = []
    monkeypatch.setattr(records, "_renamed", lambda s, path, f=records._renamed: folders.append(path) or f(s, path))
    assert records.scan_repaired(spark, "/root/testdata/sf0.001").count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    lines = records.readers.read_lines(spark, folders[0]).groupBy("path").count().collect()
    assert len(lines) >= 6 and max(r["count"] for r in lines) <= 901
