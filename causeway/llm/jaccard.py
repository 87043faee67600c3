"""N-gram Jaccard join with token-combination prefixes (operator 1), and the groups of near-duplicates that its links make.

Tokens are 64-bit hashes of word shingles; a document is its set of tokens, a *node* the set's fingerprint, so that exact copies
are one node from the start. Two nodes link when ``100 * |x & y| >= percent * |x | y|``.

Prefixes. Tokens have one global order: rare ones first, then the frequent ones, each by hash. Of x, at most
``t = n - ceil(percent / 100 * n)`` tokens are missing in a linked y. If the first t + 1 tokens are rare, they are x's keys: a
linked pair shares one of them. Otherwise all rare tokens are keys, and frequent tokens count in combinations: they are dealt by
hash into c classes, and the prefix is extended to t + 1 tokens more than it has classes, so that a linked pair which shares
no rare key shares two tokens of one class. Every pair of frequent tokens of one class in the prefix is a key. The number c
grows with the size of the sets (sizes fall into buckets by a factor of 4/3, or 100 / percent if that is more, and a set takes part in its bucket's scheme and the
next), which keeps the combinations of a set in proportion to its size.

Verification without all pairs. A key's nodes are first compared with one hub, the node of smallest fingerprint, then with
another that differs from key to key; what links falls into components. Only pairs of one key that are then still in
different components are compared one by one; so no link that joins components is lost, and a group of thousands
of near copies costs a few comparisons per member. A key's rows pass through a task in sorted order, a bounded number at a time;
a key of very many nodes is cut into pieces that share a node and are dealt to tasks like keys. Where many nodes of one key, or
of its pieces, remain apart, they are compared inside tasks, in bounded groups (two blocks of nodes whose sizes and components allow a new
link) that return only the links which join components. Comparisons use whole sets; an upper bound on the overlap, from
histograms of the tokens, spares pairs that cannot link the exchange of their sets.

Links. With the components known, all pairs of nodes of one component are compared inside tasks, in bounded groups that return
only how many documents each node links with; so every link is counted, and no row is made for a pair.

The table of frequent tokens holds at most ``FREQUENT`` entries, the most frequent ones that any batch of documents shows
several times; its content changes speed only. Intermediate results are written to the shared folder, components are
found by contraction with joins, and nothing that grows with the corpus reaches the driver.

Defined results: null, empty and wordless texts have an empty set and no links. With fewer words than a shingle has, the whole
sequence is the one token. Repeated rows and ids are documents of their own; null ids link like others, and a
component of null ids alone has a null id. Very long texts are read whole. An empty table gives no rows. Other columns,
whatever their names, are ignored. Fingerprints and tokens are 64-bit hashes, and sets are compared by 40 bits of each token.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, textvec
from .textvec import mix

WORDS, PERCENT = 5, 75
FREQUENT = 1 << 20
#: A token shown in this many documents of one batch is a candidate for the table of frequent tokens.
SEVERAL = 3
#: Keys of more nodes than LARGE, if still in several components, are compared inside tasks, in groups of two blocks at most.
LARGE, BLOCK = 48, 1024
#: Nodes of one key that a task holds at once, at least and about: a key of more is cut into pieces.
PART = 1 << 16
#: Links are counted in groups of two cells at most, of about BLOCK nodes and CELL tokens each.
CELL = 500_000
#: Nodes up to which the list of those to compare is sent to all executors; a longer one is joined by a shuffle.
FEW = 200_000
#: Sets smaller than this use single tokens of any frequency as keys.
SMALL = 8

_A, _B = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def token_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens of a chunk's texts by text and hash, the text of each, and how many each text has."""
    data = textvec.LOWER[data]
    n = len(offsets) - 1
    start, end, owner = textvec.word_bounds(data, offsets)
    hashes = textvec.Slices(data).hash(start, end)
    tokens, at = textvec.windows(hashes, owner, words)
    of = owner[at]
    sizes = np.bincount(owner, minlength=n)
    short = np.flatnonzero((sizes > 0) & (sizes < words))
    if len(short):
        first = np.searchsorted(owner, short)
        whole = np.zeros(len(short), np.uint64)
        for k in range(words - 1):
            more = sizes[short] > k
            whole[more] = mix(whole[more] * _A + hashes[first[more] + k])
        tokens = np.concatenate([tokens, mix(whole ^ sizes[short].astype(np.uint64))])
        of = np.concatenate([of, short])
    order = np.lexsort((tokens, of))
    tokens, of = tokens[order], of[order]
    keep = np.ones(len(tokens), bool)
    keep[1:] = (tokens[1:] != tokens[:-1]) | (of[1:] != of[:-1])
    tokens, of = tokens[keep], of[keep]
    return tokens, of, np.bincount(of, minlength=n)


def fingerprints(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A fingerprint of each set, as a signed 64-bit number."""
    ends = np.cumsum(sizes)
    sums = []
    for c in (_A, _B):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(tokens ^ c))])
        sums.append(total[ends] - total[ends - sizes])
    return mix(sums[0] + mix(sums[1] ^ sizes.astype(np.uint64))).view(np.int64)


def missing(n: np.ndarray, percent: int = PERCENT):
    """How many tokens of a set of size n a linked set may lack."""
    return n + (-percent * n) // 100


def _factor(percent: int) -> float:
    """The factor between buckets of sizes: linked sets are of one bucket or of two that are next to each other."""
    return max(4 / 3, 100 / percent)


def _scheme(s: int, factor: float = 4 / 3) -> int:
    """The number of classes for sets of buckets s - 1 and s; 0: single tokens."""
    least = factor ** (s - 1)
    return 0 if least < SMALL else max(1, int(least // 8))


def _combinations(rare: int, frequent: np.ndarray, n: int, percent: int) -> np.ndarray:
    """Keys of the frequent tokens of a set of n tokens, ``rare`` of which are rare and all in the prefix."""
    lack = int(missing(np.int64(n), percent))
    factor = _factor(percent)
    bucket = int(np.floor(np.log(n) / np.log(factor) + 1e-9))
    out = []
    for s in (bucket, bucket + 1):
        salt = mix(np.array([s], np.uint64))[0]
        classes = _scheme(s, factor)
        if not classes:
            out.append(mix(frequent[: lack + 1 - rare] ^ salt))
            continue
        kind = (mix(frequent ^ _B) % np.uint64(classes)).astype(np.int64)
        new = np.zeros(len(kind), np.int64)
        new[np.unique(kind, return_index=True)[1]] = 1
        enough = rare + np.arange(1, len(kind) + 1) >= lack + 1 + np.cumsum(new)
        size = int(enough.argmax()) + 1 if enough.any() else len(kind)
        order = np.argsort(kind[:size], kind="stable")
        token, kind = frequent[:size][order], kind[:size][order]
        for d in range(1, size):
            same = np.flatnonzero(kind[d:] == kind[:-d])
            if not len(same):
                break
            out.append(mix(mix(token[same] ^ salt) * _A + token[same + d]))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def prefix_keys(tokens: np.ndarray, of: np.ndarray, sizes: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a chunk's sets, and the set of each key."""
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        often = frequent[at] == tokens
    else:
        often = np.zeros(len(tokens), bool)
    rare, rare_of = tokens[~often], of[~often]
    n_rare = np.bincount(rare_of, minlength=len(sizes))
    wanted = missing(sizes, percent) + 1
    nth = np.arange(len(rare)) - np.repeat(np.cumsum(n_rare) - n_rare, n_rare)
    first = nth < wanted[rare_of]
    keys, owners = [mix(rare[first])], [rare_of[first]]
    bounds = np.searchsorted(of, np.arange(len(sizes) + 1))
    for i in np.flatnonzero((n_rare < wanted) & (sizes > 0)).tolist():
        own = slice(bounds[i], bounds[i + 1])
        found = _combinations(int(n_rare[i]), tokens[own][often[own]], int(sizes[i]), percent)
        keys.append(found)
        owners.append(np.full(len(found), i))
    return np.concatenate(keys), np.concatenate(owners)


def _members(rows: DataFrame, words: int) -> DataFrame:
    """Per document rid, doc_id, n, node; and rows of token and its number of documents in a batch (rid null)."""
    names = ["rid", "doc_id", "n", "node", "token", "shown"]

    def run(batches):
        for batch in batches:
            counted = []
            seen = np.empty(0, np.int64)
            for i, data, offsets in common.text_chunks(batch.column(2)):
                tokens, of, sizes = token_sets(data, offsets, words)
                node, n = fingerprints(tokens, sizes), len(sizes)
                none = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), batch.column(1).slice(i, n), pa.array(sizes.astype(np.int64)), pa.array(node), none, none], names)
                fresh = np.zeros(n, bool)
                fresh[np.unique(node, return_index=True)[1]] = True
                fresh &= ~np.isin(node, seen)
                seen = np.concatenate([seen, node[fresh]])
                counted.append(tokens[fresh[of]])
            token, shown = np.unique(np.concatenate(counted), return_counts=True)
            token, shown = token[shown >= SEVERAL].view(np.int64), shown[shown >= SEVERAL].astype(np.int64)
            none = pa.nulls(len(token), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(token), pa.array(shown)], names)

    return rows.mapInArrow(run, "rid bigint, doc_id bigint, n bigint, node bigint, token bigint, shown bigint")


def _keys(rows: DataFrame, frequent, words: int, percent: int) -> DataFrame:
    """key, node and n of every key of every distinct set of a batch."""

    def run(batches):
        often = frequent.value
        for batch in batches:
            seen = np.empty(0, np.int64)
            for _, data, offsets in common.text_chunks(batch.column(0)):
                tokens, of, sizes = token_sets(data, offsets, words)
                node = fingerprints(tokens, sizes)
                keys, own = prefix_keys(tokens, of, sizes, often, percent)
                fresh = np.zeros(len(sizes), bool)
                fresh[np.unique(node, return_index=True)[1]] = True
                fresh &= ~np.isin(node, seen)
                seen = np.concatenate([seen, node[fresh]])
                keep = fresh[own]
                keys, own = keys[keep], own[keep]
                for a in range(0, len(keys), 200_000):
                    o = own[a : a + 200_000]
                    yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + 200_000].view(np.int64)), pa.array(node[o]), pa.array(sizes[o].astype(np.int32))], ["key", "node", "n"])

    return rows.select("text").mapInArrow(run, "key bigint, node bigint, n int")


def _merged(held):
    """Columns (key, node, then more) of several pieces, by key and node without repeats."""
    columns = [np.concatenate(c) for c in zip(*held)]
    order = np.lexsort((columns[1], columns[0]))
    columns = [c[order] for c in columns]
    keep = np.ones(len(order), bool)
    keep[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
    return [c[keep] for c in columns]


def _groups(batches, part: int | None = None):
    """The keys of a partition that is sorted by key, some at a time: columns (key, node, then more) by key and node without repeats,
    where each key begins, and whether this is a piece of one key.

    With ``part`` a key of many nodes comes in pieces of at least so many (but the last), so a task holds a bounded number of rows.
    """
    most, held, rows = 4 * (part or PART), [], 0

    def group(columns, piece=False):
        begin = np.flatnonzero(np.concatenate([[True], columns[0][1:] != columns[0][:-1]]))
        return columns, np.append(begin, len(columns[0])), piece

    for batch in batches:
        if not len(batch):
            continue
        held.append([c.to_numpy() for c in batch.columns])
        rows += len(batch)
        if rows < most:
            continue
        columns = _merged(held)
        last = int(np.searchsorted(columns[0], columns[0][-1]))
        if last:
            yield group([c[:last] for c in columns])
        elif part and len(columns[0]) >= part:
            yield group(columns, True)
            last = len(columns[0])
        held = [[c[last:] for c in columns]]
        rows = len(columns[0]) - last
    if rows:
        yield group(_merged(held))


def _code(piece):
    """What tells the keys of pieces apart, by exclusive or; 0 for a key in one piece."""
    piece = np.asarray(piece)
    return np.where(piece > 0, mix(piece.astype(np.uint64)).view(np.int64), 0)


def _shared(part: int):
    """The rows of keys that several nodes have (key, node, n, piece).

    A key of many nodes is cut into pieces, 1, 2, ..., which are keys of their own from here on; all hold one node of the first, so
    that what links with it falls into one component whatever the piece. Other keys are piece 0.
    """

    def rows(key, node, n, piece):
        piece = np.full(len(key), piece, np.int32)
        return pa.RecordBatch.from_arrays([pa.array(key ^ _code(piece)), pa.array(node), pa.array(n), pa.array(piece)], ["key", "node", "n", "piece"])

    def run(batches):
        now, first, number = None, None, 0
        for columns, begin, piece in _groups(batches, part):
            if piece and columns[0][0] != now:
                now, first, number = columns[0][0], [c[:1] for c in columns], 1
                yield rows(*columns, number)
                continue
            if columns[0][0] == now:
                number += 1
                yield rows(*(np.concatenate([f, c[: begin[1]]]) for f, c in zip(first, columns)), number)
                columns, begin = [c[begin[1] :] for c in columns], begin[1:] - begin[1]
            several = np.repeat(np.diff(begin) > 1, np.diff(begin))
            yield rows(*(c[several] for c in columns), 0)

    return run


def _fits(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Sizes that a linked pair can have."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _pairs(a, b, na, nb):
    """Distinct pairs, the larger set (of equals the smaller fingerprint) first."""
    swap = (nb > na) | ((nb == na) & (b < a))
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    keep = np.ones(len(a), bool)
    keep[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])


def _stars(percent: int, fixed: bool):
    """Pairs of each key's hub with its other nodes that are in other components (columns key, node, n, component)."""

    def run(batches):
        for (key, node, n, component), begin, _ in _groups(batches):
            if fixed:
                hub = begin[:-1]  # rows are sorted by node
            else:
                order = np.lexsort((mix(key.view(np.uint64) ^ mix(node.view(np.uint64))), key))
                hub = order[begin[:-1]]
            hub = np.repeat(hub, np.diff(begin))
            ok = (component != component[hub]) & _fits(n, n[hub], percent)
            yield _pairs(node[hub][ok], node[ok], n[hub][ok], n[ok])

    return run


def _blocks(most: int, size: int):
    """Rows (key, block, node, n, component) of the keys that more than ``most`` nodes of several components have, and of all that are
    in pieces; a block holds about ``size`` nodes and ``CELL`` tokens of one piece.

    Large components come first, each by itself, then the other nodes by size, so that many pairs of blocks need no comparison.
    """

    def run(batches):
        for step, ((key, node, n, component, piece), begin, _) in enumerate(_groups(batches)):
            for g in np.flatnonzero((np.diff(begin) > most) | (piece[begin[:-1]] > 0)).tolist():
                i, j = begin[g], begin[g + 1]
                if not piece[i] and (component[i:j] == component[i]).all():
                    continue
                _, of, many = np.unique(component[i:j], return_inverse=True, return_counts=True)
                order = i + np.lexsort((n[i:j], np.where(many[of] >= size, of, len(many))))
                block = np.floor(np.cumsum(np.maximum(1 / size, n[order] / CELL))).astype(np.int64)
                block = mix(key[order].view(np.uint64) ^ mix((block + (step << 32)).astype(np.uint64))).view(np.int64)
                whole = key[order] ^ _code(piece[order])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (whole, block, node[order], n[order], component[order])], ["key", "block", "node", "n", "component"])

    return run


def _large(own: DataFrame, most: int, size: int, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """Rows (key, i, j, node, component): the nodes of every two blocks of a key between which a link can join components, and of each
    such block that is in no pair (i = j); and the written tables that this reads."""
    nodes = common.materialise(own.mapInArrow(_blocks(most, size), "key bigint, block bigint, node bigint, n int, component bigint"), "nodes")
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("n", "component") for f in (F.min, F.max)]
    blocks = common.materialise(nodes.groupBy("key", "block").agg(*ends), "blocks")
    a, b = blocks.alias("a"), blocks.alias("b")
    fit = 100 * F.least("a.max_n", "b.max_n") >= percent * F.greatest("a.min_n", "b.min_n")
    apart = F.least("a.min_component", "b.min_component") < F.greatest("a.max_component", "b.max_component")
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.block") < F.col("b.block")) & fit & apart)
    pairs = common.materialise(pairs.select("a.key", F.col("a.block").alias("i"), F.col("b.block").alias("j")), "block-pairs")
    ends = pairs.select("key", "i", "j", F.explode(F.array("i", "j")).alias("block"))
    alone = blocks.where("min_component < max_component").join(ends, ["key", "block"], "left_anti")
    ends = ends.unionByName(alone.select("key", F.col("block").alias("i"), F.col("block").alias("j"), "block"))
    return ends.join(nodes, ["key", "block"]).select("key", "i", "j", "node", "component"), [nodes, blocks, pairs]


def _linked(sets: list[bytes], percent: int):
    """The links of a group of sets: first their order by size, then (a, linked) for each block of sets in that order.

    linked[x, y] tells whether the sets a + x and a + y of the order link, for x < y; each pair is in one block at most.
    """
    tokens = [_unpack(s) for s in sets]
    sizes = np.array([len(t) for t in tokens])
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    yield order
    known, code, shown = np.unique(np.concatenate([tokens[k] for k in order]), return_inverse=True, return_counts=True)
    column = np.cumsum(shown > 1) - 1
    row = np.repeat(np.arange(len(order)), sizes)
    useful = shown[code] > 1
    row, code = row[useful], column[code[useful]]
    width = int((shown > 1).sum())
    m = len(order)
    step = max(64, min(width or 1, 8_000_000 // m))
    for a in range(0, m, 256):
        b = min(m, a + 256)
        most = int(np.searchsorted(sizes, 100 * int(sizes[b - 1]) // percent, "right"))
        both = np.zeros((b - a, most - a), np.float32)
        here = (row >= a) & (row < most)
        r, c = row[here] - a, code[here]
        for w in range(0, width, step):
            part = (c >= w) & (c < w + step)
            dense = np.zeros((most - a, min(step, width - w)), np.float32)
            dense[r[part], c[part] - w] = 1
            both += dense[: b - a] @ dense.T
        union = sizes[a:b, None] + sizes[None, a:most] - both
        yield a, np.triu(100 * both >= percent * union, 1)


def _join_group(nodes: list[int], component: list[int], sets: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Links that connect what the links of a group of sets connect; no others of them are returned."""
    root = {c: c for c in component}

    def top(c):
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    links = []
    found = _linked(sets, percent)
    order = next(found)
    for a, linked in found:
        for x, y in zip(*(v.tolist() for v in np.nonzero(linked))):
            p, q = order[a + x], order[a + y]
            s, t = top(component[p]), top(component[q])
            if s != t:
                root[s] = t
                links.append((nodes[p], nodes[q]))
    return links


def _count_group(cell: list[int], copies: list[int], sets: list[bytes], across: bool, percent: int) -> np.ndarray:
    """For each set of a group how many documents its links lead to; ``across``: only links from one cell to the other."""
    found = _linked(sets, percent)
    order = next(found)
    cell, copies, count = np.array(cell)[order], np.array(copies, np.float64)[order], np.zeros(len(order))
    for a, linked in found:
        b, most = a + linked.shape[0], a + linked.shape[1]
        if across:
            linked &= cell[a:b, None] != cell[None, a:most]
        linked = linked.astype(np.float64)
        count[a:b] += linked @ copies[a:most]
        count[a:most] += copies[a:b] @ linked
    out = np.empty(len(order), np.int64)
    out[order] = count
    return out


def _count_links(nodes: DataFrame, sets: DataFrame, percent: int, parts: int, size: int) -> tuple[DataFrame, DataFrame]:
    """node and others, the number of documents of other nodes that it links with (columns node, n, copies, component); and the
    written table that this reads.

    All links are inside components. The nodes of one are dealt into cells of about ``size`` nodes and ``CELL`` tokens; every two
    cells, and every cell with itself, make a group that one task compares, so each pair of a component is counted once.
    """

    def run(batches):
        now, rows = None, []

        def counted():
            node, cell, copies, tokens = zip(*rows)
            count = _count_group(cell, copies, tokens, now[1] != now[2], percent)
            return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(count)], ["node", "others"])

        for batch in batches:
            for component, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (component, i, j) != now:
                    if rows:
                        yield counted()
                    now, rows = (component, i, j), []
                rows.append(row)
        if rows:
            yield counted()

    cells = F.ceil(F.greatest(F.count("*") / size, F.sum("n") / CELL)).cast("bigint")
    several = common.materialise(nodes.groupBy("component").agg(cells.alias("cells")).where("cells > 1"), "cells")
    rows = nodes.join(F.broadcast(several) if several.count() <= FEW else several, "component", "left").withColumn("cells", F.coalesce("cells", F.lit(1)))
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("node"), F.col("cells")))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cells") - 1)))
    rows = rows.select("component", F.least("cell", "with").alias("i"), F.greatest("cell", "with").alias("j"), "node", "cell", "copies")
    dealt = common.materialise(rows, "dealt")
    rows = (F.broadcast(dealt) if dealt.count() <= FEW else dealt).join(sets.select("node", "tokens"), "node")
    rows = rows.select("component", "i", "j", "node", "cell", "copies", "tokens").repartition(parts, "component", "i", "j").sortWithinPartitions("component", "i", "j", "node")
    with common.batches_of(nodes.sparkSession, 512):
        counts = common.materialise(rows.mapInArrow(run, "node bigint, others bigint"), "counts")
    common.discard(several, dealt)
    return counts.groupBy("node").agg(F.sum("others").alias("others")), counts


def _verify_large(large: DataFrame, sets: DataFrame, percent: int, parts: int) -> DataFrame:
    """Links between the components of each bounded group of nodes, compared inside the task that holds the group."""

    def run(batches):
        now, rows = None, []
        for batch in batches:
            for key, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, i, j) != now:
                    if rows:
                        yield _links(_join_group(*zip(*rows), percent))
                    now, rows = (key, i, j), []
                rows.append(row)
        if rows:
            yield _links(_join_group(*zip(*rows), percent))

    rows = large.join(sets, "node").select("key", "i", "j", "node", "component", "tokens")
    rows = rows.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
    with common.batches_of(large.sparkSession, 512):
        return common.materialise(rows.mapInArrow(run, "a bigint, b bigint"), "links")


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])


def _across(percent: int, most: int):
    """All pairs of different components of each key that at most ``most`` nodes have."""

    def run(batches):
        out, held = [], 0

        def flush():
            return _pairs(*(np.concatenate(c) for c in zip(*out)))

        for (_, node, n, component), begin, _ in _groups(batches):
            for i, j in zip(begin.tolist(), begin[1:].tolist()):
                own = component[i:j]
                if j - i > most or (own == own[0]).all():
                    continue
                order = i + np.argsort(n[i:j], kind="stable")
                for k in range(len(order) - 1):
                    x, rest = order[k], order[k + 1 :]
                    rest = rest[: np.searchsorted(n[rest], 100 * int(n[x]) // percent, "right")]
                    rest = rest[component[rest] != component[x]]
                    if len(rest):
                        out.append((np.full(len(rest), node[x]), node[rest], np.full(len(rest), n[x]), n[rest]))
                        held += len(rest)
                    if held > 500_000:
                        merged = flush()
                        out, held = [], 0
                        yield merged
        if out:
            yield flush()

    return run


_LONG = np.dtype([("high", "<u4"), ("low", "u1")])


def _pack(tokens: np.ndarray) -> bytes:
    """Sorted tokens as 5 bytes each: their upper 40 bits."""
    out = np.empty(len(tokens), _LONG)
    out["high"], out["low"] = tokens >> np.uint64(32), (tokens >> np.uint64(24)) & np.uint64(255)
    return out.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    x = np.frombuffer(data, _LONG)
    return (x["high"].astype(np.uint64) << np.uint64(8)) | x["low"]


def _sets(rows: DataFrame, members: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node and tokens of the wanted nodes, each read from its first document."""
    first = members.groupBy("node").agg(F.min("rid").alias("rid")).join(nodes, "node", "left_semi")
    first = common.materialise(first, "first")
    texts = rows.select("rid", "text").dropDuplicates(["rid"]).join(first, "rid").select("node", "text")  # repeated rows share a rid

    def run(batches):
        for batch in batches:
            for i, data, offsets in common.text_chunks(batch.column(1)):
                tokens, _, sizes = token_sets(data, offsets, words)
                ends = np.cumsum(sizes)
                own = [tokens[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist())]
                columns = [batch.column(0).slice(i, len(own)), pa.array([_pack(t) for t in own], pa.binary()), pa.array([_histogram(t) for t in own], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["node", "tokens", "histogram"])

    with common.batches_of(rows.sparkSession, 2000):
        sets = common.materialise(texts.mapInArrow(run, "node bigint, tokens binary, histogram binary"), "sets")
    common.discard(first)
    return sets


def _row_key(docs: DataFrame) -> Column:
    """A key of a document's id and text: the same however often and in whatever order the rows are computed."""
    return F.xxhash64(docs["doc_id"].cast("bigint"), docs["text"])


def _histogram(tokens: np.ndarray) -> bytes:
    """Numbers of tokens in 256 buckets; empty where a bucket overflows a byte."""
    counts = np.bincount((tokens & np.uint64(255)).astype(np.int64), minlength=256)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose histograms allow a link: two sets share at most the lesser count of each bucket."""

    def run(batches):
        for batch in batches:
            a, b = (batch.column(k).to_pylist() for k in (2, 3))
            keep = np.array([not (x and y) for x, y in zip(a, b)], bool)
            known = np.flatnonzero(~keep)
            if len(known):
                x, y = (np.frombuffer(b"".join(c[k] for k in known), np.uint8).reshape(-1, 256) for c in (a, b))
                both = np.minimum(x, y).sum(1, dtype=np.int64)
                keep[known] = 100 * both >= percent * (x.sum(1, dtype=np.int64) + y.sum(1, dtype=np.int64) - both)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in batch.columns[:2]], ["a", "b"])

    of_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("histogram").alias("t")), "b")
    both = of_b.join(sets.select(F.col("node").alias("a"), F.col("histogram").alias("s")), "a").select("a", "b", "s", "t")
    return common.materialise(both.mapInArrow(run, "a bigint, b bigint"), "possible")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link, by their whole sets."""
    possible = pairs = _possible(pairs, sets, percent)
    nodes = common.materialise(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    sets = sets.join(F.broadcast(nodes) if nodes.count() <= FEW else nodes, "node", "left_semi")

    def run(batches):
        for batch in batches:
            kept, last, x = [], None, None
            for k, (a, s, t) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                if a != last:
                    last, x = a, _unpack(s)
                y = _unpack(t)
                at = np.searchsorted(x, y)
                at[at == len(x)] = 0
                both = int((x[at] == y).sum())
                kept.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(kept, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    of_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("t")), "b")
    both = of_b.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("s")), "a").select("a", "b", "s", "t")
    with common.batches_of(pairs.sparkSession, 512):
        links = common.materialise(both.mapInArrow(run, "a bigint, b bigint"), "links")
    common.discard(possible, nodes)
    return links


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of the nodes of links (a, b), by repeated contraction.

    Every vertex is hung below its smallest neighbour if that is smaller, chains of such pointers are shortened by doubling, and
    links are redrawn between the roots, until none is left.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    label, spent, before = None, [], None
    while True:
        edges = common.materialise(edges, "edges")
        common.discard(before)
        before = edges
        if edges.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")).select("node", F.least("node", "up").alias("up"))
        parent = table = common.materialise(parent, "parents")
        while True:
            above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            longer = parent.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("top"), "up")
            longer = common.materialise(longer, "parents")
            common.discard(table)
            table = longer
            moved = not longer.where("top <> up").isEmpty()
            parent = longer.select("node", F.col("top").alias("up"))
            if not moved:
                break
        spent.append(table)
        if label is None:
            label = parent.select("node", F.col("up").alias("component"))
        else:
            to = parent.select(F.col("node").alias("component"), "up")
            label = label.join(to, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
        for end in ("a", "b"):
            edges = edges.join(parent.select(F.col("node").alias(end), "up"), end).drop(end).withColumnRenamed("up", end)
        edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    common.discard(edges)
    if label is None:
        return links.sparkSession.range(0).select(F.col("id").alias("node"), F.col("id").alias("component"))
    label = common.materialise(label, "labels")
    common.discard(*spent)
    return label


def groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, large: int = LARGE, block: int = BLOCK, links: bool = True, part: int = PART) -> DataFrame:
    """rid (of id and text), doc_id, n_shingles, component_id, component and n_links of every document.

    component_id is the smallest doc_id of the component; ids may be null or repeated, so only component, its smallest node, tells
    components apart. n_links is the number of other documents that link with this one, copies included; ``links=False`` leaves it out.
    """
    spark = docs.sparkSession
    parts = common.partitions(spark)
    rows = docs.select(_row_key(docs).alias("rid"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    first = common.materialise(_members(rows, words), "members")
    members = first.where("rid is not null").select("rid", "doc_id", "n", "node")
    shown = first.where("token is not null").groupBy("token").agg(F.sum("shown").alias("shown"))
    often = shown.orderBy(F.desc("shown"), "token").limit(FREQUENT).select("token").toArrow().column(0).combine_chunks()
    frequent = spark.sparkContext.broadcast(np.sort(often.to_numpy().view(np.uint64)) if len(often) else np.empty(0, np.uint64))

    keys = _keys(rows, frequent, words, percent).repartition(parts, "key").sortWithinPartitions("key")
    shared = common.materialise(keys.mapInArrow(_shared(part), "key bigint, node bigint, n int, piece int"), "keys")
    common.release(spark)
    sets = _sets(rows, members.where("n > 0"), shared.select("node").distinct(), words)

    common.release(spark)
    found, label, tried, steps = [], None, None, []
    for run in (_stars(percent, True), _stars(percent, False), _across(percent, large), None):
        if label is None:
            own = shared.select("key", "node", "n", F.col("node").alias("component"), "piece")
        else:
            own = shared.join(label, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"), "piece")
        if run is None:
            apart, read = _large(own.repartition(parts, "key").sortWithinPartitions("key"), large, block, percent)
            more = _verify_large(apart, sets, percent, parts)
            common.discard(*read)
        else:
            dealt = own.drop("piece").repartition(parts, "key").sortWithinPartitions("key")
            pairs = dealt.mapInArrow(run, "a bigint, b bigint").distinct()
            if tried is not None:
                pairs = pairs.join(tried, ["a", "b"], "left_anti")
            pairs = common.materialise(pairs, "pairs")
            steps.append(pairs)
            tried = pairs if tried is None else tried.unionByName(pairs)
            more = _verify(pairs, sets, percent)
        common.release(spark)
        if label is None or not more.isEmpty():
            found.append(more)
            before, label = label, components(reduce(DataFrame.unionByName, found))
            common.discard(before)
    common.discard(shared, *steps)

    # an empty set links with nothing: each such document is alone
    nodes = members.where("n > 0").groupBy("node").agg(F.min("n").alias("n"), F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    nodes = common.materialise(nodes.join(label, "node", "left"), "nodes")
    common.discard(label, *found)
    least = nodes.groupBy(F.coalesce("component", "node").alias("component")).agg(F.min("least").alias("least"))
    own = nodes.select("node", "component", (F.col("copies") - 1).alias("n_links"))
    if links:
        others, others_table = _count_links(nodes.where("component is not null").select("node", "n", "copies", "component"), sets, percent, parts, block)
        own = own.join(others, "node", "left").select("node", "component", (F.col("n_links") + F.coalesce("others", F.lit(0))).alias("n_links"))
        own = common.materialise(own, "own")
        common.discard(others_table)
        common.release(spark)
    common.discard(sets)
    grouped = members.join(own, "node", "left").withColumn("component", F.coalesce("component", "node"))
    out = grouped.join(common.materialise(least, "least"), "component", "left")
    alone = F.col("n") == 0
    columns = ["rid", "doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"), "component"]
    return out.select(*columns, *([F.coalesce("n_links", F.lit(0)).alias("n_links")] if links else []))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group, that of smallest id (of repeated ids that of smallest key), with all its columns; rows that
    repeat an id and text, empty ones too, count once."""
    found = groups(docs, words, percent, links=False)
    chosen = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    first = found.where("n_shingles > 0").groupBy("component").agg(F.min(chosen).alias("first")).select(F.col("first.rid").alias("rid"))
    kept = common.materialise(first.unionByName(found.where("n_shingles = 0").select("rid")).distinct(), "kept")
    name = common.free_name(docs, "row_key")
    rows = docs.withColumn(name, _row_key(docs)).join(kept.withColumnRenamed("rid", name), name, "left_semi")
    return rows.dropDuplicates([name]).drop(name)


#: For small tables: it meets all pairs of documents that share a shingle.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS tokens FROM d
), n AS (SELECT r, doc_id, CAST(len(tokens) AS BIGINT) AS n FROM s),
t AS (SELECT r, unnest(tokens) AS x FROM s),
shared AS (SELECT a.r AS a, b.r AS b, count(*) AS m FROM t a JOIN t b ON a.x = b.x AND a.r < b.r GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * m >= 75 * (x.n + y.n - m)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT r AS a, r AS b FROM n UNION SELECT reach.a, ways.b FROM reach JOIN ways ON ways.a = reach.b),
least AS (SELECT a, min(doc_id) AS component_id FROM reach JOIN n ON n.r = reach.b GROUP BY 1),
many AS (SELECT a, count(*) AS n_links FROM ways GROUP BY 1)
SELECT doc_id, n AS n_shingles, component_id, coalesce(n_links, 0) AS n_links FROM n JOIN least ON least.a = n.r LEFT JOIN many ON many.a = n.r
"""
