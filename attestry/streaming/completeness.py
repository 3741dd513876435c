"""Streaming (STR-1 to STR-5): groups leave as soon as all that is expected of them has come."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def completeness_gate(stream: DataFrame, key: str, item: str, kind: str, expected: dict[str, int], timeout_ms: int | None = None, buckets: int = 4096) -> DataFrame:
    """STR-1: (key, kind, items, duplicates) once, when a key has its kind's number of distinct items.

    State is the set of items seen, then a mark that the key has left; later rows of a
    released key are dropped.  With ``timeout_ms`` the state of a key that goes quiet
    is given up.  Kinds without an expected number never leave.  Rows without a key are
    one key.

    Keys are dealt into ``buckets`` by hash, and a bucket's keys share one call and one
    state, as a call for each key costs far more than its rows.  The number is part of the
    state: it stays for the life of a checkpoint, and should grow with the keys expected.
    """

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # key: [items or, once it has left, None, kind, duplicates, time of its last row]
        held = dict(json.loads(state.get[0])) if state.exists else {}
        now = state.getCurrentProcessingTimeMs() if timeout_ms else 0
        left = []
        for batch in () if state.hasTimedOut else batches:
            for name, value, what in zip(batch["__key"].tolist(), batch["__item"].tolist(), batch["__kind"].tolist(), strict=True):
                own = held.get(name)
                if own is None:
                    own = held[name] = [[], what, 0, 0]
                own[1], own[3] = what, now
                if own[0] is None or value in own[0]:
                    own[2] += 1
                    continue
                own[0].append(value)
                if len(own[0]) == expected.get(what, -1):
                    left.append((name, what, ",".join(sorted(own[0])), own[2]))
                    own[0] = None
        if timeout_ms:
            held = {name: own for name, own in held.items() if own[3] + timeout_ms > now}
        if held:
            state.update((json.dumps(list(held.items()), separators=(",", ":")),))
            if timeout_ms:
                state.setTimeoutDuration(max(1, min(own[3] for own in held.values()) + timeout_ms - now))
        elif state.exists:
            state.remove()
        if left:
            yield pd.DataFrame(left, columns=["key", "kind", "items", "duplicates"])

    rows = stream.select(F.col(key).cast("string").alias("__key"), F.col(item).cast("string").alias("__item"), F.col(kind).cast("string").alias("__kind"))
    rows = rows.withColumn("__bucket", F.pmod(F.xxhash64("__key"), F.lit(buckets)))
    timeout = GroupStateTimeout.ProcessingTimeTimeout if timeout_ms else GroupStateTimeout.NoTimeout
    return rows.groupBy("__bucket").applyInPandasWithState(step, "key string, kind string, items string, duplicates long", "keys string", "append", timeout)


def completeness_batch(df: DataFrame, key: str, item: str, kind: str, expected: dict[str, int]) -> DataFrame:
    """The keys that :func:`completeness_gate` lets go over a finished input."""
    want = F.element_at(F.create_map(*[F.lit(x) for kv in expected.items() for x in kv]), F.col(kind).cast("string"))
    per = df.groupBy(F.col(key).cast("string").alias("key"), F.col(kind).cast("string").alias("kind")).agg(F.array_sort(F.collect_set(F.col(item).cast("string"))).alias("items"), F.first(want).alias("want"))
    return per.where(F.size("items") >= F.col("want")).select("key", "kind", F.array_join("items", ",").alias("items"))


def mix(*streams: DataFrame) -> DataFrame:
    """STR-2: streams of one shape as one."""
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def keyed_join(left: DataFrame, right: DataFrame, key: str, ts: str, within: str, how: str = "inner", lateness: tuple[str, str] | None = None) -> DataFrame:
    """STR-3: rows of two streams with one key, at most ``within`` apart; columns of the right side follow, its key and time as ``right_key`` and ``right_ts``.

    Each side has a watermark of its own (``lateness``, by default ``within`` for both),
    so either may lag; rows later than that are dropped.  The bound on both times lets
    the state of a row go once the slower watermark has passed all its possible
    partners.  ``left_outer``, ``right_outer`` and ``full_outer`` emit a row without a
    partner at that moment, once, and never before; what the watermarks haven't passed
    when a stream stops stays in its state.  Rows with a null key have no partner.
    On finished inputs it is the plain join with all of the remainder.
    """
    late = lateness or (within, within)
    a = left.withWatermark(ts, late[0]).alias("a")
    rest = [c for c in right.columns if c not in (key, ts)]
    b = right.select(F.col(key).alias("right_key"), F.col(ts).alias("right_ts"), *rest).withWatermark("right_ts", late[1]).alias("b")
    span = F.expr(f"interval {within}")
    near = (F.col(f"a.{key}") == F.col("b.right_key")) & (F.col("b.right_ts") >= F.col(f"a.{ts}") - span) & (F.col("b.right_ts") <= F.col(f"a.{ts}") + span)
    return a.join(b, near, how)


def run_to_end(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """The rows that ``stream`` appends to Parquet files in ``path`` until its sources have nothing more, read again.

    ``checkpoint`` keeps offsets and state, so a further call goes on where this one stopped.
    """
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
