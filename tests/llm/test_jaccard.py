import random
import re

import numpy as np
import pytest

from causeway.llm import jaccard

from .helpers import PROSE, doc, frame, hard_documents


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and 100 * both >= 75 * len(x | sets[j]):
                root[top(i)] = top(j)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[top(i)] = min(ids.get(top(i), r[0]), r[0])
    return [(r[0], len(sets[i]), (ids.get(top(i)) if sets[i] else r[0])) for i, r in enumerate(rows)]


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def near_copies(n, words, edits, seed):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rnd.randint(0, edits)):
            own[rnd.randrange(words)] = f"x{rnd.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_hard_documents(spark):
    rows = hard_documents()
    assert found(jaccard.groups(frame(spark, rows))) == sorted(brute(rows), key=str)


def test_empty_table(spark):
    assert jaccard.groups(frame(spark, [])).collect() == []
    assert jaccard.keep_one(frame(spark, [])).collect() == []


def test_chains_passages_and_groups_against_brute_force(spark):
    rnd = random.Random(3)
    texts = near_copies(25, 60, 4, 1) + near_copies(12, 200, 9, 2) + near_copies(30, 30, 3, 5) + near_copies(8, 9, 1, 6)
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"u{rnd.randrange(10**6)}" for _ in range(rnd.choice([3, 8, 15, 60]))) for _ in range(25)]
    step = [f"c{i}" for i in range(60)]
    texts += [" ".join(step[i : i + 50]) for i in range(0, 11, 2)]  # a chain: neighbours link, ends don't
    rows = [doc(1000 - i, t) for i, t in enumerate(texts)] + [doc(2000, texts[0])]
    df = frame(spark, rows).repartition(3)
    want = sorted(brute(rows), key=str)
    assert found(jaccard.groups(df)) == want
    assert found(jaccard.groups(df, large=6, block=8)) == want  # the groups of one key are compared inside tasks


def test_keys_cut_into_pieces_lose_no_link(spark):
    rnd = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = near_copies(40, 60, 6, 21) + [passage + " " + " ".join(f"u{rnd.randrange(10**6)}" for _ in range(rnd.choice([3, 8, 15, 60]))) for _ in range(40)]
    rows = [doc(i, t) for i, t in enumerate(texts)] * 2
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = found(jaccard.groups(frame(spark, rows).repartition(3), large=6, block=5, part=4))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == sorted(brute(rows), key=str)


def test_pieces_of_a_key_hold_all_its_nodes_and_share_one():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    key = np.sort(np.concatenate([np.full(500, 7), np.full(3, 9), [11], rng.integers(20, 60, 200)]))
    node = rng.integers(0, 300, len(key))
    batches = [pa.RecordBatch.from_arrays([pa.array(key[a : a + 13]), pa.array(node[a : a + 13]), pa.array(np.ones(len(key[a : a + 13]), np.int32))], ["key", "node", "n"]) for a in range(0, len(key), 13)]
    rows = [r for b in jaccard._shared(20)(batches) for r in b.to_pylist()]
    whole = {}
    for r in rows:
        k = r["key"] ^ int(jaccard._code(np.array([r["piece"]]))[0])
        whole.setdefault(k, {}).setdefault(r["piece"], set()).add(r["node"])
    want = {k: set(node[key == k].tolist()) for k in set(key.tolist())}
    assert {k: set().union(*v.values()) for k, v in whole.items()} == {k: v for k, v in want.items() if len(v) > 1}
    assert len(whole[7]) > 2 and set.intersection(*whole[7].values()) and max(len(v) for v in whole[7].values()) <= 4 * 20 + 13 + 1


@pytest.mark.parametrize("block", [jaccard.BLOCK, 8])
def test_every_link_is_counted(spark, block):
    texts = near_copies(40, 80, 2, 1) + near_copies(30, 30, 3, 5) + near_copies(3, 80, 1, 7)
    texts += [" ".join(f"c{k}" for k in range(i, i + 50)) for i in range(0, 11, 2)] + texts[:3] + [None, ""]
    sets = [shingles(t) for t in texts]
    links = [sum(i != j and bool(x) and 100 * len(x & y) >= 75 * len(x | y) for j, y in enumerate(sets)) for i, x in enumerate(sets)]
    out = jaccard.groups(frame(spark, [doc(i, t) for i, t in enumerate(texts)]), large=6, block=block)
    assert {r.doc_id: r.n_links for r in out.collect()} == dict(enumerate(links)) and sum(links) > 500


def test_keep_one_keeps_the_smallest_of_each_group_with_all_columns(spark):
    rows = hard_documents()
    kept = jaccard.keep_one(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and ids.count(9) == 1 and 10 not in ids and ids.count(2) == 1 and {3, 4, 5} <= set(ids) and None in ids


def test_keep_one_tells_groups_apart_whose_ids_are_null_or_repeated(spark):
    a, b, c, d, e = near_copies(1, 40, 0, 11) + near_copies(1, 40, 0, 12) + near_copies(1, 40, 0, 13) + near_copies(1, 40, 0, 14) + near_copies(1, 40, 0, 15)
    rows = [doc(None, a), doc(None, a + " more"), doc(None, b), doc(2, c), doc(2, d), doc(3, d + " more"), doc(None, e), doc(7, e + " more")]
    kept = sorted((r.doc_id or 0, r.text.removesuffix(" more")) for r in jaccard.keep_one(frame(spark, rows)).collect())
    assert kept == sorted([(0, a), (0, b), (2, c), (2, d), (7, e)])


@pytest.mark.parametrize("seed", range(4))
def test_linked_sets_share_a_key(seed):
    rng = np.random.default_rng(seed)
    tried = 0
    for _ in range(400):
        x = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 300)), dtype=np.uint64))
        y = rng.permutation(x)[int(rng.integers(0, len(x) // 4 + 1)) :]
        y = np.unique(np.concatenate([y, rng.integers(0, 2**63, int(rng.integers(0, max(1, len(x) // 6))), dtype=np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 75 * (len(x) + len(y) - both):
            continue
        tried += 1
        share = rng.random() if tried % 3 else 1.0
        often = np.unique(np.concatenate([z[rng.random(len(z)) < share] for z in (x, y)]))
        a, b = (set(jaccard.prefix_keys(z, np.zeros(len(z), np.int64), np.array([len(z)]), often)[0].tolist()) for z in (x, y))
        assert a & b
    assert tried > 100


@pytest.mark.parametrize("percent", [40, 50, 60, 75, 90])
def test_linked_sets_of_frequent_tokens_share_a_key_at_any_percent(percent):
    rng = np.random.default_rng(percent)
    for _ in range(300):
        x = np.unique(rng.integers(0, 2**63, int(rng.integers(20, 300)), dtype=np.uint64))
        y = np.sort(rng.permutation(x)[: -(-percent * len(x) // 100)])  # as small as a linked set can be
        a, b = (set(jaccard.prefix_keys(z, np.zeros(len(z), np.int64), np.array([len(z)]), x, percent)[0].tolist()) for z in (x, y))
        assert a & b


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    labels = dict(map(tuple, jaccard.components(edges).collect()))
    assert set(labels[i] for i in range(41)) == {0} and labels[101] == labels[100] == 100


def test_packed_tokens_keep_forty_bits():
    x = np.sort(np.random.default_rng(0).integers(0, 2**63, 50, dtype=np.uint64))
    assert (jaccard._unpack(jaccard._pack(x)) == x >> np.uint64(24)).all() and PROSE
