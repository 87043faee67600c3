"""Token counts (operator 4): pieces are counted once per distinct pre-token and joined to per-document frequencies.

1. A task cuts its texts into pre-tokens and counts them per document. Frequent pre-tokens (a table of at most ``HOT``
   entries of at most ``WIDE`` characters, so a broadcast of bounded size) are joined at once and summed: they are what would make
   a skewed key. The other (pre-token, document, frequency) rows are written.
2. The distinct pre-tokens of those rows are counted, each once, with the tokenizer library: a table (pre-token, number of pieces).
3. That table is joined to the rows by pre-token, and the products are summed per document. Token ids are never kept.

Row keys are made while the rows are written and read back from there, so a repeated task can't change them.

Defined results: a null text counts as empty (0 bytes, 0 tokens, not over the limit). Each row is counted by itself, so
repeated rows and ids give repeated results; a null id stays null. Very long texts are counted whole. An empty table gives
no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import os
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .bpe import pieces_of, special_pattern

#: Entries of the table of frequent pre-tokens, and documents from which it is chosen. It changes speed only.
HOT, SAMPLE = 131_072, 8_000
#: Characters of a pre-token in that table, and pre-tokens that the library gets in one call.
WIDE, CALL = 64, 20_000


class PieceCounter:
    """Numbers of pieces of many strings, by the library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self._count = lambda texts: [len(x.ids) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        else:
            from sentencepiece import SentencePieceProcessor

            processor = SentencePieceProcessor(model_file=path)
            self._count = lambda texts: [len(x) for x in processor.encode(texts, num_threads=1)]

    def __call__(self, keys: list[str]) -> np.ndarray:
        return np.array([n for i in range(0, len(keys), CALL) for n in self._count(keys[i : i + CALL])], np.int64)


def frequent(docs: DataFrame, path: str, hot: int = HOT, sample: int = SAMPLE) -> dict[str, int]:
    """The most frequent pre-tokens of a bounded sample, each with its number of pieces."""
    rows = docs.count()
    if not rows:
        return {}
    special = special_pattern(path)

    def run(batches):
        seen = Counter()
        for batch in batches:
            for _, data, offsets in common.text_chunks(batch.column(0)):
                seen.update(pieces_of(data, offsets, special)[0])
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["piece", "n"])

    some = docs.where(F.expr(f"pmod(xxhash64(doc_id), {max(1, rows // sample)}) = 0")).select("text")
    top = some.mapInArrow(run, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n")).where((F.col("n") > 1) & (F.length("piece") <= WIDE))
    keys = [r[0] for r in top.orderBy(F.desc("n"), "piece").limit(hot).collect()]
    return dict(zip(keys, PieceCounter(path)(keys).tolist()))


def frequencies(docs: DataFrame, known: dict[str, int], special) -> DataFrame:
    """Written rows: per document its key (rid), doc_id, n_bytes and n, the tokens of its pre-tokens in ``known``; per other pre-token of a
    document the piece, the document's key and n, how often it is there."""
    table = docs.sparkSession.sparkContext.broadcast(known)
    names = ["piece", "rid", "n", "doc_id", "n_bytes"]

    def run(batches):
        known = table.value
        for batch in batches:
            ids, rids = batch.column(0), batch.column(1).to_numpy()
            for i, data, offsets in common.text_chunks(batch.column(2)):
                pieces, bounds = pieces_of(data, offsets, special)
                bounds = bounds.tolist()
                rest, owner, freq, sums = [], [], [], []
                for a, b in zip(bounds, bounds[1:]):
                    total, before = 0, len(rest)
                    for piece, n in Counter(pieces[a:b]).items():
                        if (tokens := known.get(piece)) is not None:
                            total += n * tokens
                        else:
                            rest.append(piece)
                            freq.append(n)
                    owner.append(len(rest) - before)
                    sums.append(total)
                n = len(sums)
                rid = rids[i : i + n]
                yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.string()), pa.array(rid), pa.array(sums, pa.int64()), ids.slice(i, n), pa.array(np.diff(offsets))], names)
                if rest:
                    m = len(rest)
                    yield pa.RecordBatch.from_arrays([pa.array(rest, pa.string()), pa.array(np.repeat(rid, owner)), pa.array(freq, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], names)

    keyed = common.with_row_key(docs.select("doc_id", "text")).select(F.col("doc_id").cast("bigint"), "rid", "text")
    return common.materialise(keyed.mapInArrow(run, "piece string, rid bigint, n bigint, doc_id bigint, n_bytes bigint"), "frequencies")


def counted(pieces: DataFrame, path: str) -> DataFrame:
    """piece and tokens of a table of distinct pre-tokens."""

    def run(batches):
        count = PieceCounter(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count(batch.column(0).to_pylist()))], ["piece", "tokens"])

    return pieces.mapInArrow(run, "piece string, tokens bigint")


def count_by_pretoken(docs: DataFrame, path: str, limit: int = 512, hot: int = HOT) -> DataFrame:
    """Counts under a tokenizer that splits texts by the byte-level pattern (a .json file)."""
    rows = frequencies(docs, frequent(docs, path, hot), special_pattern(path))
    other = rows.where("piece is not null").select("piece", "rid", "n")
    tokens = common.materialise(counted(other.select("piece").distinct(), path), "pieces")
    # every side is a written table, so the exchanges of the join are plain and a hot pre-token's can be split
    products = other.join(tokens, "piece").select("rid", (F.col("n") * F.col("tokens")).alias("n_tokens"), F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("n_bytes"))
    own = rows.where("piece is null").select("rid", F.col("n").alias("n_tokens"), "doc_id", "n_bytes")
    total = own.unionByName(products).groupBy("rid").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens"))
    return total.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def count_whole(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """Counts under a tokenizer whose pieces cross blanks (a .model file): it has no pre-tokens, so each text is encoded once."""

    def run(batches):
        counter = PieceCounter(path)
        for batch in batches:
            text = batch.column(1).fill_null("").to_pylist()
            for i in range(0, len(text), 64):
                some = text[i : i + 64]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, len(some)), pa.array([len(x.encode()) for x in some], pa.int64()), pa.array(counter(some))], ["doc_id", "n_bytes", "n_tokens"])

    out = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 512, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    return count_by_pretoken(docs, path, limit, hot) if path.endswith(".json") else count_whole(docs, path, limit)
