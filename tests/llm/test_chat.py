import hashlib
import random

from pyspark.sql import functions as F

from causeway.llm import chat

ROWS = "conv_id bigint, turn bigint, role string, text string, tree string, node string, depth string, part string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "t", "n", "d", "p") for r in rows], ROWS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    out = []
    for conv, own in by.items():
        own.sort(key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r[1:2]) + tuple((x is not None, x or "") for x in r[2:4]))
        pairs = [(r[2] or "", r[3] or "") for r in own]
        loss = "".join(t for role, t in pairs if role == "assistant")
        out.append((conv, len(pairs), sha("".join(f"{role}\n{t}\n" for role, t in pairs)), len(loss), sha(loss)))
    return sorted(out, key=str)


def hard_turns():
    tricky = [chat.TRICKY, "\\", "\\\\b", "###", "####", "\\h", "</turn>", "<</turn>>", "</turn>\n### user: x", "a\\e:b", "😀 é", "", None, "x" * 200_000]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(tricky)]
    rows += [(2, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "assistant", "tie"), (2, None, None, "null turn"), (None, 1, "user", "null id"), (None, 2, "assistant", "x"), (3, 5, "ro:le ### </turn>\\", "odd role")]
    return rows + [(4, i, "assistant", f"turn {i}") for i in range(300)]


def test_round_trip(spark):
    rows = hard_turns()
    out = chat.digest(turns(spark, rows)).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256").collect()
    assert sorted(map(tuple, out), key=str) == expected(rows)
    assert chat.digest(turns(spark, [])).collect() == []


def test_marks_appear_only_as_marks(spark):
    out = chat.render(chat.branches(chat.linear(turns(spark, hard_turns())))).where("tree = 1").first()
    assert out.formatted.count("</turn>") == 14 and out.formatted.count("###") == 14


NODES = "tree bigint, node bigint, parent bigint, role string, text string, score double"


def test_best_branches_of_a_tree(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "good", 3.0), (1, 3, 1, "assistant", "bad", 1.0), (1, 4, 2, "user", "more", 0.5), (1, 5, 3, "user", "why", 2.0), (1, 6, 5, "assistant", "so", 0.25), (2, 9, 77, "user", "orphan", None)]
    nodes = spark.createDataFrame(rows, NODES)
    found = chat.branches(nodes, best=2).groupBy("tree", "leaf", "branch").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("depth", "text"))), lambda t: t.text), " ").alias("path"))
    assert sorted(map(tuple, found.collect())) == [(1, 4, 1, "q good more"), (1, 6, 2, "q bad why so"), (2, 9, 1, "orphan")]


def test_messages_of_a_cycle_are_listed(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 4, "user", "x", 9.0), (1, 4, 3, "user", "y", 9.0), (1, 5, 4, "user", "below", 9.0), (2, 1, 1, "user", "self", 0.0), (3, 1, None, "user", "z", 0.0)]
    nodes = spark.createDataFrame(rows, NODES)
    assert sorted(map(tuple, chat.cyclic(nodes).collect())) == [(1, 3), (1, 4), (1, 5), (2, 1)]
    found = chat.branches(nodes, best=5)
    assert sorted((r.tree, r.depth, r.text) for r in found.collect()) == [(1, 1, "q"), (1, 2, "a"), (3, 1, "z")]


def test_branches_equal_brute_force(spark):
    rnd = random.Random(4)
    rows = [(t, i, rnd.choice([None, *range(i)][-4:]) if i else None, "user", f"m{i}", rnd.choice([0.0, 0.5, 1.0, None])) for t in range(6) for i in range(rnd.choice([1, 2, 17, 40]))]
    best = 3
    want = []
    for t in {r[0] for r in rows}:
        own = {r[1]: r for r in rows if r[0] == t}
        paths = []
        for leaf in own.keys() - {r[2] for r in own.values()}:
            path, at = [], leaf
            while at is not None:
                path.append(at)
                at = own[at][2]
            paths.append((-sum(own[i][5] or 0.0 for i in path), leaf, path[::-1]))
        want += [(t, leaf, rank, depth, own[i][4]) for rank, (_, leaf, path) in enumerate(sorted(paths)[:best], 1) for depth, i in enumerate(path, 1)]
    found = chat.branches(spark.createDataFrame(rows, NODES), best).select("tree", "leaf", "branch", "depth", "text")
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_no_python_runs_in_the_plan(spark):
    plan = chat.digest(turns(spark, hard_turns()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
