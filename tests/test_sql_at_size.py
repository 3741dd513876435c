"""SQL that states the same rule whatever the size of a table."""

import duckdb

from attestry.plans import registry


def test_ids_keep_all_their_digits():
    con = duckdb.connect()
    con.execute("create view lineitem as select i as l_orderkey, 1 as l_linenumber, 'N' as l_returnflag, 1 as l_partkey, 1 as l_suppkey from range(1000001) r(i)")
    ids = con.execute(f"select count(distinct sequence_id), min(sequence_id), max(length(sequence_id)) from ({registry.SQL['norm_ids']})").fetchone()
    assert ids == (1_000_001, "N__c000001", len("N__c1000001"))
