"""Best-fit packing of documents into bins of fixed size, under conflicts.

A bin never holds two pieces of one source or of one duplicate cluster. Within a shard, pieces go by
falling size into the open bin with the least room that is enough and has no conflict: bins are
ordered by residual, carry bitmaps of their sources and clusters, and the search moves to the next
larger residual until a bin is compatible.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import inputs

CAPACITY = 2_048
#: Documents of a shard, on average; a shard is packed by one task.
SHARD = 4_096


class Bins:
    """Open bins by residual. A bin is (sources, clusters, number); equal bitmaps share one entry."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.by_room: list[dict[tuple[int, int], list[int]]] = [{} for _ in range(capacity + 1)]
        self.rooms = 0  # bit r is set while some bin has residual r
        self.count = 0

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset) for a piece; ``source`` and ``cluster`` are bitmaps. Ties go to the oldest bin."""
        left = self.rooms >> size
        room = size
        while left:
            step = (left & -left).bit_length() - 1
            room += step
            best = None
            for key, bins in self.by_room[room].items():
                if not (key[0] & source or key[1] & cluster) and (best is None or bins[0] < best[1]):
                    best = (key, bins[0])
            if best:
                self._take(room, *best)
                self._put(room - size, (best[0][0] | source, best[0][1] | cluster), best[1])
                return best[1], self.capacity - room
            left >>= step + 1
            room += 1
        self.count += 1
        self._put(self.capacity - size, (source, cluster), self.count - 1)
        return self.count - 1, 0

    def _take(self, room: int, key: tuple[int, int], number: int) -> None:
        bins = self.by_room[room][key]
        bins.remove(number)
        if not bins:
            del self.by_room[room][key]
            if not self.by_room[room]:
                self.rooms &= ~(1 << room)

    def _put(self, room: int, key: tuple[int, int], number: int) -> None:
        if room == 0 and self.capacity:
            return  # a full bin takes no more
        bins = self.by_room[room].setdefault(key, [])
        bins.append(number)
        bins.sort()
        self.rooms |= 1 << room


def pack_shard(ids: list, sources: list, clusters: list, sizes: list[int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(row, piece, size, bin, offset) of every piece of the shard's rows.

    A row longer than a bin is cut into pieces of a whole bin and a rest. Pieces go by falling size,
    then by id (null last) and piece. A null source conflicts with none, a null cluster only with its own row.
    """
    cuts = [
        (k, piece, min(capacity, size - piece * capacity))
        for k, size in enumerate(sizes)
        for piece in range(max(1, -(-size // capacity)))
    ]
    cuts.sort(key=lambda c: (-c[2], ids[c[0]] is None, ids[c[0]] or 0, c[0], c[1]))
    source_bit: dict = {}
    cluster_bit: dict = {}
    own = [("row", k) if c is None else ("cluster", c) for k, c in enumerate(clusters)]
    often = Counter(own[k] for k, _, _ in cuts)
    bins, out = Bins(capacity), []
    for k, piece, size in cuts:
        source = 0 if sources[k] is None else 1 << source_bit.setdefault(sources[k], len(source_bit))
        # a cluster with one piece in the shard cannot conflict
        cluster = 1 << cluster_bit.setdefault(own[k], len(cluster_bit)) if often[own[k]] > 1 else 0
        out.append((k, piece, size, *bins.place(size, source, cluster)))
    return out


def n_words(text: str = "text") -> F.Column:
    """Words of a text, between white space; null counts as empty."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"\S+")), F.lit(0))


def copy_cluster(text: str = "text") -> F.Column:
    """Hash of the lower-cased words: texts that differ in case and white space only share it."""
    return F.xxhash64(F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+", " ")))


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, cluster`` of documents: words, and the cluster of copies."""
    return docs.select("doc_id", "source", n_words().alias("size"), copy_cluster().alias("cluster"))


def best_fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    size_col: str = "size",
    source_col: str = "source",
    cluster_col: str = "cluster",
    capacity: int = CAPACITY,
    shard_docs: int = SHARD,
) -> DataFrame:
    """``doc_id, piece, n_words, bin_id, offset`` for every piece of every row.

    Rows are dealt over shards by a hash of all their columns and a number among equal rows, so a hot source,
    cluster or id is spread evenly, repeated rows are too, and no task holds more than about ``shard_docs``
    rows. Each row is packed. ``bin_id`` is the shard and the bin's number in it. Sizes that are null or
    negative count as 0. Only ids, sizes and labels are shuffled, not texts.
    """
    rows = inputs(docs, doc_id=id_col, size=size_col, source=source_col, cluster=cluster_col)
    rows = rows.withColumn("size", F.greatest(F.coalesce(F.col("size").cast("long"), F.lit(0)), F.lit(0)))
    n = max(1, -(-docs.count() // shard_docs))
    # equal rows are counted and numbered anew, which gives the same numbers in any order of the tasks
    rows = rows.groupBy("doc_id", "size", "source", "cluster").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "size", "source", "cluster", "number"), F.lit(n))).drop("number")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(shard: pa.Table) -> pa.Table:
        order = [("doc_id", "ascending"), ("size", "ascending"), ("source", "ascending"), ("cluster", "ascending")]
        shard = shard.sort_by(order)
        columns = [shard.column(c).to_pylist() for c in ("doc_id", "source", "cluster", "size")]
        packed = np.array(pack_shard(*columns, capacity), np.int64).reshape(-1, 5)
        number = int(shard.column("shard")[0].as_py()) << 32
        return pa.table({
            "doc_id": shard.column("doc_id").take(pa.array(packed[:, 0])),
            "piece": pa.array(packed[:, 1].astype(np.int32)),
            "n_words": pa.array(packed[:, 2]),
            "bin_id": pa.array(packed[:, 3] + number),
            "offset": pa.array(packed[:, 4].astype(np.int32)),
        })

    schema = f"doc_id {kind}, piece int, n_words long, bin_id long, offset int"
    return rows.groupBy("shard").applyInArrow(run, schema)

