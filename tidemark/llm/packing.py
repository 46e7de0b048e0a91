"""Best-fit packing into sequences of several permitted lengths.

Documents become pieces of at most the largest permitted length: full ones and a
rest. Pieces are taken by falling length; each goes to the open bin that it leaves
with the least room. If it fits none, a bin is opened. A bin of length L costs
``overhead + L + L * L / attention``: a sequence's own cost, its tokens' and that of
their attention to each other, so long bins pay only where they spare room.

The lengths are optimised jointly: for every opening each permitted length that holds
the piece is tried ahead, filled up with the largest pieces still to come that fit, and
the one of the least cost a token is opened. So bins of all lengths are open together,
and small pieces fill the rooms of long bins before short ones are opened for them. In
the end each bin shrinks to the shortest permitted length that holds its contents. As a
safeguard the packings with one usual length are made as well, and the cheapest stays.

Pieces are dealt at random into shards of about ``SHARD`` pieces, which are packed
independently: a shard's size does not grow with the corpus, and packing loses about
one open bin of each size a shard.

Defined cases: a null or empty text has its end token only; null doc_ids are packed
like others; repeated rows are packed once each; an empty table gives no bins.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tidemark.llm.counting import ranked
from tidemark.plans import durable

LENGTHS = (1024, 2048, 4096)
OVERHEAD = 64
ATTENTION = 16_384  # the length at which attention costs as much as all the rest
SHARD = 20_000


def token_lengths(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens): ids of each text and an end token."""

    def lengths(texts: pa.Array) -> pa.Array:
        own = ranked(path)
        return pa.array([len(own.encode_ordinary(t or "")) + 1 for t in texts.to_pylist()], pa.int64())

    return docs.select("doc_id", arrow_udf(lengths, "bigint")("text").alias("n_tokens"))


def best_fit(sizes, opening, lengths) -> tuple[list[int], list[int], list[int]]:
    """Best fit of falling sizes: (bin of each, room opened, room filled, by bin).

    ``opening`` is the usual length of a new bin, longer only for pieces that need it, or
    gives the length for the k-th piece.
    """
    room: dict[int, list[int]] = {}
    rooms: list[int] = []  # the distinct rooms of open bins, rising
    opened, filled, where = [], [], []
    for k, size in enumerate(sizes):
        at = bisect_left(rooms, size)
        if at < len(rooms):
            left = rooms[at]
            bins = room[left]
            target = bins.pop()
            if not bins:
                del room[left]
                rooms.pop(at)
        else:
            if callable(opening):
                left = opening(k)
            else:
                left = opening if opening >= size else lengths[bisect_left(lengths, size)]
            target = len(opened)
            opened.append(left)
            filled.append(0)
        filled[target] += size
        where.append(target)
        left -= size
        if left:
            if left in room:
                room[left].append(target)
            else:
                room[left] = [target]
                insort(rooms, left)
    return where, opened, filled


def least_cost_opening(falling: list[int], lengths, cost):
    """The length to open for the k-th of falling sizes: that of the least cost a token,
    if it is filled with the largest later pieces that fit and shrunk to its contents."""
    rising = [-s for s in falling]

    def opening(k: int) -> int:
        best = None
        for length in lengths[bisect_left(lengths, falling[k]) :]:
            filled, at = falling[k], k + 1
            while filled < length:
                at = bisect_left(rising, filled - length, at)  # the first that fits
                if at == len(falling):
                    break
                filled += falling[at]
                at += 1
            rate = cost(lengths[bisect_left(lengths, filled)]) / filled
            if best is None or rate < best[0]:
                best = rate, length
        return best[1]

    return opening


def bin_cost(overhead: int = OVERHEAD, attention: int = ATTENTION):
    return lambda length: overhead + length + length * length / attention


def pack(sizes: np.ndarray, lengths=LENGTHS, overhead: int = OVERHEAD, attention: int = ATTENTION):
    """(bin of each piece, length of each bin) at the least total cost found."""
    lengths, cost = sorted(lengths), bin_cost(overhead, attention)
    order = np.argsort(-sizes, kind="stable")
    falling = sizes[order].tolist()
    best = None
    for opening in (least_cost_opening(falling, lengths, cost), *lengths):
        where, _, filled = best_fit(falling, opening, lengths)
        shrunk = [lengths[bisect_left(lengths, f)] for f in filled]
        total = sum(map(cost, shrunk))
        if best is None or total < best[0]:
            best = total, where, shrunk
    out = np.empty(len(sizes), np.int64)
    out[order] = best[1]
    return out, np.array(best[2], np.int64)


def pieces(lengths: DataFrame, longest: int) -> DataFrame:
    """(doc_id, row, piece, start, length): documents cut to the longest permitted length."""
    starts = F.sequence(F.lit(0), F.col("n_tokens") - 1, F.lit(longest))
    return lengths.select(
        "doc_id", "row", "n_tokens", F.posexplode(starts).alias("piece", "start")
    ).select(
        "doc_id",
        "row",
        F.col("piece").cast("long").alias("piece"),
        F.col("start").cast("long").alias("start"),
        F.least(F.lit(longest), F.col("n_tokens") - F.col("start")).cast("long").alias("length"),
    )


def best_fit_packing(
    docs: DataFrame,
    path: str,
    lengths=LENGTHS,
    overhead: int = OVERHEAD,
    shard: int = SHARD,
    attention: int = ATTENTION,
) -> DataFrame:
    """One row a piece: its bin, the bin's length, and its place in both.

    (bin_id, capacity, used, place, doc_id, piece, start, length); ``place`` is where
    the piece begins in the bin, ``start`` where it begins in the document.
    """

    def run(table: pa.Table) -> pa.Table:
        order = np.lexsort(
            (table.column("piece").to_numpy(), table.column("row").to_numpy())
        )
        table = table.take(pa.array(order)).combine_chunks()
        size = table.column("length").to_numpy()
        where, capacity = pack(size, lengths, overhead, attention)
        number = table.column("shard")[0].as_py() << 32
        by_bin = np.argsort(where, kind="stable")
        sums = np.cumsum(size[by_bin])
        first = np.searchsorted(where[by_bin], np.arange(len(capacity)))
        before = sums[first] - size[by_bin][first]
        place = np.empty(len(size), np.int64)
        place[by_bin] = sums - size[by_bin] - before[where[by_bin]]
        used = np.bincount(where, size).astype(np.int64)
        return pa.table(
            {
                "bin_id": number + where,
                "capacity": capacity[where],
                "used": used[where],
                "place": place,
                "doc_id": table.column("doc_id"),
                "piece": table.column("piece"),
                "start": table.column("start"),
                "length": size,
            }
        )

    counted = durable(token_lengths(docs, path)).withColumn("row", F.monotonically_increasing_id())
    cut = pieces(counted, max(lengths))
    shards = max(1, -(-cut.count() // shard))
    kinds = dict(counted.dtypes)
    return (
        cut.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(
            run,
            "bin_id bigint, capacity bigint, used bigint, place bigint, "
            f"doc_id {kinds['doc_id']}, piece bigint, start bigint, length bigint",
        )
    )
