"""Models against plain versions that loop over texts, bytes and documents."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tallybeat.llm import langid, quality

TEXTS = {
    "en": "the old mill by the river was quiet in the morning and nobody came to ask for bread",
    "fr": "la vieille maison près de la rivière reste calme le matin et personne ne demande le pain",
    "de": "die alte mühle am fluss war am morgen still und niemand kam um nach brot zu fragen",
}


def plain_costs(train):
    """Code length of a text in each language, by trees of contexts walked byte by byte."""
    trees = {lang: [defaultdict(Counter) for _ in range(langid.ORDER + 1)] for lang in TEXTS}
    for text, lang in train:
        data = bytes(langid.ORDER) + text.encode()
        for i in range(langid.ORDER, len(data)):
            for k in range(langid.ORDER + 1):
                trees[lang][k][data[i - k : i]][data[i]] += 1

    def bits(lang, data, i, k):
        if k < 0:
            return 8.0
        seen = trees[lang][k].get(data[i - k : i])
        if not seen:
            return bits(lang, data, i, k - 1)
        total = sum(seen.values()) + len(seen)
        if data[i] in seen:
            return -math.log2(seen[data[i]] / total)
        return -math.log2(len(seen) / total) + bits(lang, data, i, k - 1)

    def cost(text):
        data = bytes(langid.ORDER) + text.encode()
        return {lang: sum(bits(lang, data, i, langid.ORDER) for i in range(langid.ORDER, len(data))) for lang in TEXTS}

    return cost


def test_languages_are_those_of_the_plain_trees(spark):
    rng = np.random.default_rng(8)
    some = lambda lang, n: " ".join(rng.choice(TEXTS[lang].split(), n))
    train = [(i, some(lang, 12), lang) for i in range(60) for lang in TEXTS]
    schema = "doc_id long, text string, lang string"
    table = spark.createDataFrame(train, schema)
    learned = {r.doc_id for r in table.filter(~langid.held_out(table.doc_id)).select("doc_id").distinct().collect()}
    cost = plain_costs([(text, lang) for i, text, lang in train if i in learned])
    asked = [some("en", 5), some("fr", 9), some("de", 3), some("en", 4) + " " + some("fr", 4), "zq", "ß", "the " * 40, some("de", 900)]
    rows = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(rows, langid.fit(table)).collect()}
    for i, text in enumerate(asked):
        rate = {lang: bits / len(text.encode()) for lang, bits in cost(text).items()}
        best = min(sorted(rate), key=rate.get)
        assert got[i].lang_pred == best
        assert got[i].bits_per_byte == pytest.approx(rate[best], rel=1e-4)
        assert got[i].score == pytest.approx(1 / sum(2 ** (-16 * (r - rate[best])) for r in rate.values()), abs=1e-3)


def plain_posteriors(documents, rounds=100):
    """Expectation maximisation over single documents, one after another."""
    good = [0.02 if sum(v == 0 for v in d) * 2 > sum(v == 1 for v in d) else 0.98 for d in documents]
    for _ in range(rounds):
        sides = [[1 - g for g in good], good]
        logs = []
        for side in sides:
            prior = (sum(side) + 1) / (len(documents) + 2)
            tables = []
            for j in range(len(documents[0])):
                share = {v: 0.5 + sum(w for w, d in zip(side, documents, strict=True) if d[j] == v) for v in (-1, 0, 1)}
                tables.append({v: s / sum(share.values()) for v, s in share.items()})
            logs.append([math.log(prior) + sum(math.log(t[v]) for t, v in zip(tables, d, strict=True)) for d in documents])
        good = [1 / (1 + math.exp(a - b)) for a, b in zip(*logs, strict=True)]
    return good


def test_label_model_is_that_of_single_documents():
    rng = np.random.default_rng(6)
    truth = rng.random(300) < 0.8
    sure = [0.9, 0.8, 0.7, 0.6]
    documents = [
        tuple(int(t if rng.random() < s else not t) if rng.random() < 0.8 else -1 for s in sure) for t in truth
    ]
    found = quality.label_model(sorted(Counter(documents).items()))
    for votes, p in zip(documents, plain_posteriors(documents), strict=True):
        assert found[votes] == pytest.approx(p, abs=1e-9)
    right = sum((found[d] >= 0.5) == t for d, t in zip(documents, truth, strict=True))
    assert right / len(truth) > 0.85


def test_scorer_follows_plain_gradient_steps(monkeypatch):
    monkeypatch.setattr(quality, "STEPS", 5)
    rng = np.random.default_rng(7)
    texts = pa.array([" ".join(rng.choice(["ab", "cde", "fghij", "klmnopq", "r."], 6)) for _ in range(40)])
    target = rng.random(40)
    row, column = quality.features(texts)
    held = [sorted({c for r, c in zip(row, column, strict=True) if r == i}) for i in range(40)]
    spread = Counter(c for cs in held for c in cs)
    held = [[c for c in cs if spread[c] >= quality.FEWEST] for cs in held]
    share = min(max(target.mean(), 0.01), 0.99)
    weight, offset = defaultdict(float), 0.0
    for _ in range(5):
        errors = []
        for cs, y in zip(held, target, strict=True):
            p = 1 / (1 + math.exp(-(offset + sum(weight[c] for c in cs))))
            errors.append((y / share + (1 - y) / (1 - share)) / 2 * (p - y) / 40)
        for c in {c for cs in held for c in cs}:
            slope = sum(e for e, cs in zip(errors, held, strict=True) if c in cs)
            moved = weight[c] - quality.RATE / math.sqrt(spread[c] / 40) * slope
            weight[c] = math.copysign(max(abs(moved) - quality.RATE * quality.SPARSE, 0), moved)
        offset -= quality.RATE * sum(errors)
    w, b = quality.fit(texts, target)
    assert b == pytest.approx(offset, abs=1e-9)
    assert {int(c): w[c] for c in np.flatnonzero(w)} == pytest.approx({int(c): v for c, v in weight.items() if v}, abs=1e-9)
