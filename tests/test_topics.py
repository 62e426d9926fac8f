"""Topics of windows: planted themes, alignment, drift and assignment against brute force."""

import itertools
import random

import numpy as np

from broadsheet.operators import topics
from broadsheet.operators.features import tfidf_long


def test_assignment_equals_the_best_of_all_permutations():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 5, 6):
        for _ in range(15):
            gain = rng.integers(0, 6, (n, n)) / 5
            got = topics.best_assignment(gain)
            assert sorted(got) == list(range(n))
            best = max(sum(gain[i, p[i]] for i in range(n)) for p in itertools.permutations(range(n)))
            assert abs(sum(gain[i, got[i]] for i in range(n)) - best) < 1e-9


def test_topics_that_swap_numbers_are_aligned():
    a = np.eye(4, 12) * 5 + np.eye(4, 12, 4) * 3 + np.eye(4, 12, 8) + 1e-3
    order = [2, 0, 3, 1]
    again = a[order][[1, 0, 3, 2]]
    numbers = topics.aligned([a, a[order], again], top=3)
    assert numbers[0].tolist() == [0, 1, 2, 3] and numbers[1].tolist() == order
    assert [int(np.abs(a - t).sum(1).argmin()) for t in again] == numbers[2].tolist()


THEMES = {0: "goal match team league player", 1: "bank market stock trade price", 2: "virus doctor health clinic vaccine"}


def planted(rng, n):
    """Documents of three themes over four windows; in the third window the second theme changes two of its words."""
    rows, windows = [], []
    for i in range(n):
        theme, w = rng.randrange(3), i % 4
        words = THEMES[theme].split()
        if theme == 1 and w >= 2:
            words = [*words[:3], "bond", "yield"]
        rows.append((i, [rng.choice(words) for _ in range(12)]))
        windows.append((i, w))
    return rows, windows


def test_models_of_windows_follow_planted_themes(spark):
    rng = random.Random(3)
    rows, windows = planted(rng, 240)
    windows += [(i, w + 1) for i, w in windows if w < 3 and i % 7 == 0]  # windows overlap
    weights = tfidf_long(spark.createDataFrame(rows, "id bigint, tokens array<string>"), "id", "tokens", lo=1, hi=1)
    words, shares = topics.window_models(weights, spark.createDataFrame(windows, "id bigint, window_id bigint"), "id", k=3, rounds=20, words=5, align_words=5)
    sets = {}
    for r in words.collect():
        sets.setdefault((r.topic, r.window_id), set()).add(r.term)
    themes = {frozenset(v.split()): k for k, v in THEMES.items()}
    number = {themes[frozenset(sets[t, 0])]: t for t in range(3)}  # every theme is a topic of the first window
    for w in range(4):
        assert sets[number[0], w] == set(THEMES[0].split()) and sets[number[2], w] == set(THEMES[2].split())
    assert sets[number[1], 3] == {"bank", "market", "stock", "bond", "yield"}
    drift = {r.topic: r for r in topics.topic_drift(words).collect()}
    for t in range(3):
        j = [len(sets[t, w] & sets[t, w + 1]) / len(sets[t, w] | sets[t, w + 1]) for w in range(3)]
        assert abs(drift[t].similarity - sum(j) / 3) < 1e-9 and abs(drift[t].max_drift - (1 - min(j))) < 1e-9
    assert drift[number[1]].most_volatile and drift[number[0]].drift == 0
    per = {}
    for r in shares.collect():
        per.setdefault(r.window_id, []).append((r.p, r.rows))
    count = {w: len({i for i, x in windows if x == w}) for w in range(4)}
    assert all(abs(sum(p for p, _ in v) - 1) < 1e-6 and {n for _, n in v} == {count[w]} for w, v in per.items())


def test_shares_of_rows_do_not_keep_the_tokens_in_memory(spark, monkeypatch):
    from broadsheet.operators import features
    seen, made = [], features.CountVectorizer

    def estimator(**options):
        seen.append((options["minDF"], options["maxDF"]))
        return made(**options)

    monkeypatch.setattr(features, "CountVectorizer", estimator)
    rows = spark.createDataFrame([(["all", "some"],)] * 15 + [(["all", "some", "once"],)] + [(["all", "few"],)] * 4, "tokens array<string>")
    assert features.count_model(rows, "tokens").vocabulary == ["some", "few"]  # all is in more than 95 of 100 rows
    assert features.count_model(rows, "tokens", min_df=0.5).vocabulary == ["some"]
    assert all(least >= 1 and most >= 1 for least, most in seen)  # below 1 the estimator persists its input
