import re

import corpus_pipeline
from causeway.llm import common, langid, quality

from .helpers import frame, hard_documents


def first_of_each_group(rows):
    """The smallest id of each group of linked texts, by sets of words and all pairs."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)})
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] != {()} and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return set(least.values())


def test_stages_take_effect_in_order(spark, sf):
    docs = common.table(spark, sf, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "quality rules", "n-gram Jaccard join", "best-fit packing"]
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in left.select("doc_id").collect()}
        if name == "language ID":
            want = {r.doc_id for r in langid.identify(left, langid.fit(left)).collect() if not r.rejected}
        elif name == "quality rules":
            want = {r.doc_id for r in quality.judge(left, common.table(spark, sf, "labels")).collect() if r.kept}
        else:
            want = first_of_each_group([(r.doc_id, r.text) for r in left.select("doc_id", "text").collect()])
        left = common.materialise(stage(spark, left, sf), "stage")
        after = {r.doc_id for r in left.select("doc_id").collect()}
        assert left.columns == docs.columns and after == want and after <= before
    packed = corpus_pipeline.STAGES[-1][1](spark, left, sf)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == after
    assert corpus_pipeline.run(spark, sf).count() == packed.count()


def test_hard_and_empty_documents_pass_through(spark, sf):
    for rows in (hard_documents(), []):
        docs = frame(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = common.materialise(stage(spark, docs, sf), "stage")
        assert "sequence_id" in docs.columns
