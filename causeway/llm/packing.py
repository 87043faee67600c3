"""Sum-of-squares packing (operator 3).

Documents are tokenised and cut into pieces of at most ``capacity`` tokens. Pieces of one length are interchangeable, so
the placement is planned on the histogram of lengths, which has at most ``capacity`` entries however large the corpus. The plan takes
the lengths from the longest to the shortest and puts pieces where the sum over residual gaps of the squared number of open
sequences becomes smallest: into an open sequence, or a new one. It places bundles of equal pieces, a ``RESOLUTION``-th of a
length's count each (single pieces where there are no more than that), into groups of sequences that are alike; so one plan covers
every count, its work does not grow with the corpus, and nothing is planned apart. A new sequence is a choice for as long as
fewer are open than a share of those that the tokens fill; from then on it is opened only where no gap fits. A few shares are
tried, and the plan of fewest sequences is kept.

The executors then give every piece its rank within its length and look its place up. The plan is a table of bounded size; no
row of the corpus reaches the driver.

Defined results: a null text counts as empty and gives one piece, the closing id alone. Repeated rows and ids are packed
each by itself. Very long texts give many pieces, all but the first of full length. An empty table gives no rows.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .bpe import Lookup, added_tokens, json_vocabulary, kept, special_pattern

CAPACITY, CLOSING = 1024, 2
#: Bundles into which the pieces of one length are dealt.
RESOLUTION = 256
#: Pieces of one length that are ranked together, about.
GROUP = 1024
#: Shares of the sequences that the tokens fill, up to which a new one may be opened though a gap fits.
SHARES = (0.95, 0.99, 1.0)


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, closing: int = CLOSING) -> DataFrame:
    """rid, doc_id, piece, start, length, ids_crc32 of the pieces of every document."""

    def make():
        return Lookup(json_vocabulary(path), added_tokens(path), special_pattern(path))

    names = ["rid", "doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches):
        enc = kept(("lookup", path), make)
        for batch in batches:
            doc_ids, rids = batch.column(0), batch.column(1)
            for i, data, offsets in common.text_chunks(batch.column(2)):
                rows, starts, lengths, crcs, pieces = [], [], [], [], []
                ids, bounds = enc.ids(data, offsets)
                ids = np.insert(ids, bounds[1:], closing).astype("<u4", copy=False).tobytes()
                bounds = (4 * (bounds + np.arange(len(bounds)))).tolist()
                for k, (begin, end) in enumerate(zip(bounds, bounds[1:]), i):
                    n = (end - begin) // 4
                    edges = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                    for p, (a, b) in enumerate(zip(edges, edges[1:])):
                        rows.append(k)
                        pieces.append(p)
                        starts.append(a)
                        lengths.append(b - a)
                        crcs.append(zlib.crc32(ids[begin + 4 * a : begin + 4 * b]))
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([rids.take(at), doc_ids.take(at), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())], names)

    rows = common.with_row_key(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")).select("doc_id", "rid", "text")
    return rows.mapInArrow(run, "rid bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def sum_of_squares(histogram: dict[int, int], capacity: int = CAPACITY, most: float = float("inf"), resolution: int = RESOLUTION) -> tuple[np.ndarray, int]:
    """Rows (length, first, base, offset, count) and the number of sequences: pieces ``first`` to ``first + count - 1`` of ``length`` go at
    ``offset`` of the sequences ``base`` and following, one each.

    With N(g) open sequences of gap g, a piece of length s goes into a gap g >= s or a new sequence, whichever changes the
    sum of N(g)**2 least; of equal choices into an open one, of smallest gap. With ``most`` sequences open, a new one is opened only
    where no gap fits.
    """
    twice = np.zeros(capacity + 1, np.int64)  # 2 N(g); at gap 0, which isn't open, the constant that the algebra leaves
    twice[0] = -1
    alike: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # of each gap, groups (base, count) of sequences
    rows, made = [], 0
    for s in sorted(histogram, reverse=True):
        left = histogram[s]
        bundle = left if s == capacity else -(-left // resolution)
        first = 0
        while left:
            k, at = min(bundle, left), capacity
            if s < capacity:
                here = twice[s:capacity]
                change = np.where(here > 0, twice[: capacity - s] - here + 2, 1 << 60)
                best = int(change.argmin())
                least = int(change[best])
                if least < 1 << 60 and (made >= most or least <= twice[capacity - s] + 1):
                    at = s + best
            if at < capacity:
                base, count = alike[at].pop()
                k = min(k, count)
                if count > k:
                    alike[at].append((base + k, count - k))
                twice[at] -= 2 * k
            else:
                base, made = made, made + k
            rows.append((s, first, base, capacity - at, k))
            if at > s:
                alike[at - s].append((base, k))
                twice[at - s] += 2 * k
            first += k
            left -= k
    return np.array(rows, np.int64).reshape(-1, 5), made


def plan(histogram: dict[int, int], capacity: int = CAPACITY, resolution: int = RESOLUTION) -> dict[str, np.ndarray]:
    """The rows of the best of the plans with ``SHARES``, by length and first rank, and the number of sequences."""
    filled = -(-sum(s * n for s, n in histogram.items()) // capacity)
    rows, made = min((sum_of_squares(histogram, capacity, share * filled, resolution) for share in SHARES), key=lambda found: found[1])
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    return {name: rows[:, k] for k, name in enumerate(("length", "first", "base", "offset"))} | {"sequences": np.array([made])}


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a table already written, with rid, piece and length) with sequence_id and offset."""
    spark = pieces.sparkSession
    lengths = common.materialise(pieces.groupBy("length").count(), "lengths")  # at most ``capacity`` rows
    histogram = {r[0]: r[1] for r in lengths.collect()}
    table = spark.sparkContext.broadcast(plan(histogram, capacity))
    salts = lengths.select("length", F.ceil(F.col("count") / GROUP).alias("salts"))
    salted = pieces.join(F.broadcast(salts), "length").withColumn("salt", F.expr("pmod(xxhash64(rid, piece), salts)")).drop("salts")
    group = Window.partitionBy("length", "salt")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("in_group"))
    counts = counts.select("length", "salt", F.coalesce(F.sum("in_group").over(before), F.lit(0)).alias("earlier"))
    ranked = salted.withColumn("nth", F.row_number().over(group.orderBy("rid", "piece"))).join(counts, ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("earlier") + F.col("nth") - 1).select(*pieces.columns, "rank")

    def look_up(batches):
        t = table.value
        key = (t["length"] << 44) + t["first"]
        for batch in batches:
            own = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            at = np.searchsorted(key, (own << 44) + rank, "right") - 1
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(t["base"][at] + rank - t["first"][at]), pa.array(t["offset"][at])], [*batch.schema.names[:-1], "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(look_up, f"{schema}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, closing: int = CLOSING) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    with common.batches_of(docs.sparkSession, 2000):
        pieces = common.materialise(cut(docs, path, capacity, closing), "pieces")
    return place(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
