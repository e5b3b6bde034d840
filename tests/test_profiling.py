import random
from difflib import SequenceMatcher

import pytest

from shelfwise.operators import profiling as pf


def test_similar_keys_find_every_pair(spark, eav):
    rng = random.Random(3)
    bases = ["".join(rng.choices("abcde_", k=rng.randint(2, 18))) for _ in range(40)]
    keys = set(bases)
    for b in bases:
        for _ in range(4):
            s = list(b)
            for _ in range(rng.randint(1, 3)):
                i = rng.randrange(len(s) + 1)
                if rng.random() < 0.5:
                    s.insert(i, rng.choice("abcde_"))
                elif s:
                    del s[min(i, len(s) - 1)]
            keys.add("".join(s) or "q")
    keys = sorted(keys, key=lambda k: (hash(k), k))
    rows = eav(*[(1, "specs", i, k, "v") for i, k in enumerate(keys)])
    for threshold in (0.85, 0.8, 0.6):
        want = {
            (a, b) for i, a in enumerate(keys) for b in keys[i + 1:] if SequenceMatcher(None, a, b).ratio() >= threshold
        }
        got = {(r.key1, r.key2) for r in pf.similar_keys(pf.key_table(rows), threshold).collect()}
        assert got == want


def test_similar_keys_refuse_impossible_thresholds(spark, eav):
    for threshold in (0, 1.5):
        with pytest.raises(ValueError):
            pf.similar_keys(pf.key_table(eav((1, "specs", 0, "a", "b"))), threshold)


def test_similar_keys_skip_one_suffix_cluster_and_keep_order(spark, eav):
    rows = eav((1, "specs", 0, "spin_speed", "1"), (1, "specs", 1, "timer_mode", "1"), (1, "specs", 2, "timer", "1"), (1, "specs", 3, "spin_sped", "1"))
    got = pf.similar_keys(pf.key_table(rows)).collect()
    assert [(r.key1, r.key2, r.similarity) for r in got] == [("spin_speed", "spin_sped", 0.95)]


def test_normalization_candidates(spark):
    profile = spark.createDataFrame(
        [("c", "Black"), ("c", "black"), ("n", "0"), ("n", "1,5"), ("one", "x"), ("y", "Ja"), ("y", "Maybe"), ("t_value", "a"), ("t_value", "b"),
         ("t_value", "c"), ("three", "a"), ("three", "b"), ("three", "c"), ("two", "a"), ("two", "b")],
        "key string, value string",
    )
    assert {r.key for r in pf.normalization_candidates(profile).collect()} == {"c", "y", "three"}


def test_samples_are_the_first_ten(spark, eav):
    rows = eav(*[(p, "specs", 0, "k", f"{p} kg") for p in range(30)], (5, "specs", 1, "sku", "x"))
    row = pf.analyze_keys(rows).collect()
    assert [(r.key, r.products, r.samples, r.unit_values) for r in row] == [("k", 30, [f"{p} kg" for p in range(10)], 30)]
