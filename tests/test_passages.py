import random
import re

import pytest

from shelfwise.operators import passages as ps
from shelfwise.rules import CONTENTS_LINES, DENSITY_PATTERNS, MARKETING_WORDS, PASSAGE_SEPARATOR


def plain_score(text):
    hits = {name: len(re.findall(regex, text, re.I)) for name, regex, _ in DENSITY_PATTERNS}
    score = float(sum(hits[name] * weight for name, _, weight in DENSITY_PATTERNS))
    score *= 1.5 if sum(h > 0 for h in hits.values()) >= 3 else 1
    score *= 2 if hits["spec_headers"] else 1
    score *= 0.5 if len(re.findall(MARKETING_WORDS, text, re.I)) > 5 else 1
    return score / len(text) * 1000


def plain_passage(text, budget):
    """The greedy choice as a loop."""
    if len(text) <= 5000 or len(text) <= budget:
        return text
    spans = [(s, min(s + 1000, len(text))) for s in range(0, len(text), 500)]
    ranked = sorted(((-plain_score(text[a:b]), a, b) for a, b in spans if b - a >= 400))
    chosen, gathered = [], 0
    for order, a, b in ranked:
        if order >= 0 or gathered >= budget * 1.2:
            break
        if gathered + b - a <= budget * 1.5:
            chosen.append((a, b))
            gathered += b - a
    if not ranked or ranked[0][0] >= 0:
        return text[:budget]
    runs = []
    for a, b in sorted(chosen):
        if sum(y - x for x, y in runs) + b - a > budget:
            break
        if runs and a < runs[-1][1]:
            runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
        else:
            runs.append((a, b))
    joined = PASSAGE_SEPARATOR.join(text[a:b] for a, b in runs)
    return "\n".join(line for line in joined.split("\n") if not any(re.match(p, line.strip()) for p in CONTENTS_LINES))


def random_text(rng):
    words = ["wash", "amazing", "capacity", "5 kg", "Weight: 12 cm", "the", "premium", "features", "10 x 20 x 30 cm", "power", "a: b: c", "\n", "best", "plain", "words", "été"]
    weights = [rng.random() for _ in words]
    return " ".join(rng.choices(words, weights, k=rng.randint(20, 3000)))


@pytest.mark.parametrize("budget", [900, 1500, 2400, 4000])
def test_passages_match_a_plain_loop(spark, budget):
    rng = random.Random(budget)
    texts = {i: random_text(rng) for i in range(60)}
    texts[60], texts[61] = "zzz " * 2000, ""
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.passage for r in ps.select_passages(docs, budget).collect()}
    for i, text in texts.items():
        assert got[i] == plain_passage(text, budget), i


def test_contents_lines_are_dropped(spark):
    docs = spark.createDataFrame([(1, "Camera . . . . . . . . . . 3\nWeight: 5 kg\n. . . . . . . . . 8\nGetting started here\nChapter 2 Using it")], "doc_id long, text string")
    assert ps.drop_toc_lines(docs).first().text == "Weight: 5 kg"


def test_no_shuffle(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert "Exchange" not in ps.select_passages(docs, 1000)._jdf.queryExecution().executedPlan().toString()
