import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from causeway.llm import common, langid, quality

from .helpers import PROSE, doc, frame, hard_documents


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered))


def test_counts_against_brute_force(spark):
    rows = hard_documents() + [doc(50, "a b a b a b\nx\nx\n x\n\n\n#|#")]
    out = quality.judge(frame(spark, rows), None).collect()
    want = []
    for r in rows:
        b = base(r[1])
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        want.append((r[0], *b, failed, not failed))
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)


def test_trees_are_monotone_and_separate():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(quality.FEATURES)))
    y = ((x[:, 0] < 0.5) & (x[:, 7] > 0.2) ^ (rng.random(3000) < 0.02)).astype(float)
    judge = quality.Judge(x, y)
    assert ((judge.trees.score(x) > 0.5) == y).mean() > 0.95
    steps = np.linspace(0, 1, 50)
    for j, sign in enumerate(quality.FEATURES.values()):
        if sign:
            rows = np.repeat(x[:20, None], 50, 1)
            rows[:, :, j] = steps
            scores = judge.trees.score(rows.reshape(-1, x.shape[1])).reshape(20, 50)
            assert (np.diff(scores, axis=1) * sign >= -1e-12).all()


def test_quality_on_labelled_documents(spark, sf):
    docs, labels = common.table(spark, sf, "documents"), common.table(spark, sf, "labels")
    out = quality.judge(docs, labels).join(labels, "doc_id").where("not base_failed").toPandas()
    assert out[out.quality == 1].kept.mean() > 0.95 and (out[out.quality == 0].kept.mean() < 0.3 or not (out.quality == 0).any())


@pytest.mark.parametrize("labels", [[], [(1, 1, None)], [(None, None, 0), (1, None, 1)]])
def test_quality_without_usable_labels(spark, labels):
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert quality.judge(frame(spark, hard_documents()), table).count() == len(hard_documents())
    assert quality.judge(frame(spark, []), table).collect() == []
    kept = quality.keep_good(frame(spark, hard_documents()), table)
    assert kept.columns == frame(spark, []).columns and all(not r.text or len(r.text.split()) >= 50 for r in kept.collect())


def test_language_held_out_accuracy(spark, sf):
    docs = common.table(spark, sf.replace("sf0.001", "sf0.01"), "documents")
    out = langid.identify(docs, langid.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = out[out.held_out]
    assert len(held) > 200 and (held.lang_pred == held.lang).mean() > 0.96
    assert out.score.between(0, 1).all() and out.rejected.mean() < 0.01
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(out.doc_id, out.held_out))


def test_language_of_hard_documents(spark):
    german = "der schnelle braune fuchs springt über den faulen hund und niemand stört sich am regen "
    learn = [doc(100 + i, (PROSE if i % 2 else german) * 2, "en" if i % 2 else "de") for i in range(60)]
    rows = hard_documents() + learn
    model = langid.fit(frame(spark, rows))
    out = langid.identify(frame(spark, rows), model).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[1].lang_pred == "en" and by[100].lang_pred == "de" and not by[9].rejected
    for k in (3, 4, 5, 13):
        assert (by[k].lang_pred, by[k].score, by[k].rejected) == ("und", 0.0, True)
    assert not by[None].held_out
    kept = langid.keep_known(frame(spark, rows), model)
    assert kept.columns == frame(spark, []).columns and kept.where("doc_id in (3, 4, 5, 13)").count() == 0 and kept.where("doc_id >= 100").count() == 60


def test_language_without_anything_to_learn(spark):
    rows = [doc(1, "words here", None), doc(2, None, "en"), doc(None, "text", "en")]
    assert langid.fit(frame(spark, rows)) is None
    assert {r.lang_pred for r in langid.identify(frame(spark, rows), None).collect()} == {"und"}
    assert langid.identify(frame(spark, []), None).collect() == []


def test_kneser_ney_probabilities_sum_to_one():
    texts = ["abab abba baba", "bab ab aab"]
    model = langid.Model({"x": [langid.symbols(*langid._flat(texts))[:2]]})
    alphabet = sorted({*"".join(texts)})
    for context in ("ab ", "bab", "aba", "zzz"):
        rows = [context + c for c in alphabet] + [context + "q"]
        data, offsets = common.text_bytes(pa.array(rows))
        x, _, _ = langid.symbols(*common.codepoints(data, offsets)[1:])
        at = np.arange(len(rows)) * 7 + 6
        p = np.exp(model.log_probabilities(x, at)[:, 0])
        assert abs(p.sum() - 1) < 1e-4


def naive_entropy(training: dict[str, list[str]], text: str) -> dict[str, float]:
    """Interpolated Kneser-Ney by its definition, with dictionaries."""
    order, blank = langid.ORDER, chr(langid.BLANK)

    def places(t):
        t = blank * (order - 1) + "".join(c.lower() if c.isalpha() else blank for c in t)
        return [t[i - order + 1 : i + 1] for i in range(order - 1, len(t)) if t[i] != blank or t[i - 1] != blank]

    counts = {}
    for lang, texts in training.items():
        own = {order: Counter(g for t in texts for g in places(t))}
        for k in range(order - 1, 0, -1):
            own[k] = Counter(g[1:] for g in own[k + 1])
        counts[lang] = own
    alphabet = len({g for own in counts.values() for g in own[1]}) + 1
    out = {}
    for lang, own in counts.items():
        discount, total, kinds = {}, {}, {}
        for k in own:
            n1, n2 = (sum(v == n for v in own[k].values()) for n in (1, 2))
            discount[k] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            total[k], kinds[k] = Counter(), Counter()
            for g, v in own[k].items():
                total[k][g[:-1]] += v
                kinds[k][g[:-1]] += 1

        def p(g, own=own, discount=discount, total=total, kinds=kinds):
            k = len(g)
            if not k:
                return 1 / alphabet
            n = total[k][g[:-1]]
            if not n:
                return p(g[1:])
            return max(own[k][g] - discount[k], 0) / n + discount[k] * kinds[k][g[:-1]] / n * p(g[1:])

        found = places(text)
        out[lang] = -sum(math.log(p(g)) for g in found) / len(found)
    return out


def test_cross_entropy_equals_the_definition():
    training = {"en": ["the quick brown fox jumps over the lazy dog", "a stone in the river, and the rain"], "fr": ["le renard brun saute par dessus le chien", "une pierre dans la rivière"], "x": ["zzz"]}
    model = langid.Model({lang: [langid.symbols(*langid._flat(own))[:2]] for lang, own in training.items()})
    for text in ("the dog and the stone", "la pierre brune", "zz qq", "The RIVER rivière!", "日本"):
        got = model.cross_entropy(*langid._flat([text]))[0]
        want = naive_entropy(training, text)
        assert all(abs(got[i] - want[lang]) < 1e-4 for i, lang in enumerate(model.languages)), (text, got, want)


def test_text_of_other_languages_is_rejected(spark, sf):
    docs = common.table(spark, sf.replace("sf0.001", "sf0.01"), "documents")
    model = langid.fit(docs)
    others = ["Tämä on suomenkielinen lause, jota malli ei ole koskaan nähnyt, ja se on aivan tavallista proosaa talosta ja metsästä.", "Это предложение написано по-русски, и модель никогда его не видела раньше.", "この文は日本語で書かれていて、モデルは見たことがありません。", "Ten tekst jest po polsku i mówi o domu, lesie, rzece oraz o pogodzie nad morzem."]
    rows = langid.identify(frame(spark, [doc(i, t, None) for i, t in enumerate(others)]), model).collect()
    assert all(r.rejected and 0 <= r.score <= 1 for r in rows)


def test_flattened_trees_score_like_a_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 3)).round(1)
    y = (x[:, 0] - x[:, 1] + 0.3 * rng.normal(size=600) > 0).astype(float)
    trees = quality.Trees(trees=12).fit(x, y, np.array([1, -1, 0]))

    def walk(row, at):
        while trees.child[0, at] != at:
            at = trees.child[int(row[trees.feature[at]] <= trees.threshold[at]), at]
        return trees.value[at]

    want = [1 / (1 + math.exp(-trees.start - sum(walk(row, r) for r in trees.roots))) for row in x]
    assert np.allclose(trees.score(x), want, rtol=1e-12)
