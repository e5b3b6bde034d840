from pyspark.sql import functions as F

from shelfwise.functions.tables import rule_table
from shelfwise.operators import attributes as at
from shelfwise.operators import standardize as st
from shelfwise.plans.standardizing import RuleSet, product_rules, standardize


AUTO_UNITS = [
    ("2.1 cm", "k_cm", "2.1"),
    ("630 mm", "k_cm", "63"),
    ("635 mm", "k_cm", "63.5"),
    ("A to G", "k", "A to G"),
    ("50%", "k", "50%"),
    ("230°C", "k_deg", "230"),
    ("£1,299", "k_gbp", "1"),
    ("220-240V", "k_v", "240"),
    ("3 a day", "k_a", "3"),
    ("1700 watts", "k", "1700 watts"),
    ("1.5 kWh", "k_kwh", "1.5"),
    ("  8 litres ", "k_l", "8"),
    ("42", "k", "42"),
]


def test_auto_units(eav, pairs):
    rows = eav(*[(i, "specs", 0, "k", value) for i, (value, _, _) in enumerate(AUTO_UNITS)])
    assert pairs(st.extract_units_auto(rows)) == [(key, number) for _, key, number in AUTO_UNITS]


def test_auto_units_keep_existing_suffix_and_strict_percent(eav, pairs):
    assert pairs(st.extract_units_auto(eav((1, "specs", 0, "load_kg", "8 kg")))) == [("load_kg", "8")]
    assert pairs(st.extract_units_auto(eav((1, "specs", 0, "k", "50%")), strict=True)) == [("k_percent", "50")]


RULE_UNITS = [
    ("630 mm", ["cm"], "width_cm", "63"),
    ("630 mm", ["mm"], "width_mm", "630"),
    ("6,2 Litres", ["L", "Litres"], "capacity_l", "6.2"),
    ("1–48 hr", ["hr"], "delay_hr", "1-48"),
    ("about 5 kg net", ["kg"], "weight_kg", "about 5net"),
    ("1,2,3", ["kg"], "weight_kg", "1.2,3"),
    ("Quick programme", ["min"], "quick", "Quick programme"),
    ("x.y (kg)", ["(kg)"], "w", "x.y"),
]


def test_rule_units(spark, eav, pairs):
    keys = [f"k{i}" for i in range(len(RULE_UNITS))]
    rules = rule_table(spark, {"key": keys, "units": [u for _, u, _, _ in RULE_UNITS], "new_key": [n for _, _, n, _ in RULE_UNITS]})
    rows = eav(*[(i, "specs", 0, keys[i], value) for i, (value, _, _, _) in enumerate(RULE_UNITS)])
    assert pairs(st.extract_units_rules(rows, rules)) == [(new, expected) for _, _, new, expected in RULE_UNITS]
    last_but_one = pairs(st.extract_units_rules(rows, rules, strict=False))[6]
    assert last_but_one == ("quick", "Quick prograe")


def test_collision_keeps_first_position_and_last_value(eav):
    rows = st.resolve_collisions(eav((1, "specs", 0, "a", "x"), (1, "specs", 1, "b", "y"), (1, "specs", 2, "a", "z"))).collect()
    assert {(r.ord, r.key, r.value) for r in rows} == {(0, "a", "z"), (1, "b", "y")}


def test_unify_keeps_first_of_comparable_keys(spark, eav, pairs):
    merges = rule_table(spark, {"alias": ["cap"], "canonical": ["capacity_litres"]})
    rows = eav((1, "specs", 0, "cap", "1"), (1, "specs", 1, "capacity_l", "2"), (1, "specs", 2, "depth", "3"), (1, "specs", 3, "dep_th", "4"), (1, "specs", 4, "dept_h", "5"))
    assert pairs(st.unify_keys(rows, merges)) == [("capacity_litres", "1"), ("depth", "3"), ("dept_h", "5")]


def test_one_shuffle_form_equals_two_steps(spark, eav):
    merges = rule_table(spark, {"alias": ["b"], "canonical": ["a"]})
    rows = eav(*[(p, "specs", o, k, f"{p}{o}") for p in range(3) for o, k in enumerate(["b", "a_cm", "b", "c", "a", "C"])])
    two = st.unify_keys(st.resolve_collisions(rows), merges)
    assert sorted(map(tuple, st.resolve_and_unify(rows, merges).collect())) == sorted(map(tuple, two.collect()))


def test_gap_fill_never_changes_a_primary_value(eav, pairs):
    primary = eav((1, "specs", 0, "a", ""), (1, "specs", 1, "b", "p"))
    extra = eav((1, "specs", 0, "b", "e"), (1, "specs", 1, "c", "e"))
    assert pairs(at.fill_gaps(primary, extra)) == [("b", "p"), ("c", "e"), ("a", "")]
    assert pairs(at.fill_gaps(primary, extra, strict=True)) == [("a", ""), ("b", "p"), ("c", "e")]


def test_coverage_is_monotone(eav):
    rows = eav(*[(p, "specs", k, f"k{k}", "v") for p in range(20) for k in range(5) if p % (k + 1) == 0])
    kept = [st.filter_coverage(rows, F.lit(20), pct).select("key").distinct().count() for pct in (0, 10, 30, 60, 100)]
    assert kept == sorted(kept, reverse=True) and kept[0] == 5 and kept[-1] == 1


def test_kinds_move_and_overwrite(eav):
    rows = eav(
        (1, "specs", 0, "light", "Yes"), (1, "features", 0, "light", "Sometimes"), (1, "features", 1, "rpm", "900"),
        (2, "specs", 0, "light", "no"), (2, "features", 0, "timer", "true"), (2, "features", 1, "empty", " "),
        (3, "features", 0, "light", "Often"), (3, "specs", 1, "door", "yes"), (3, "features", 1, "door", "No"),
    )
    got = {(r.product_id, r.kind, r.key): r.value for r in st.assign_kinds(rows).collect()}
    assert got == {
        (1, "specs", "light"): "Yes", (1, "specs", "rpm"): "900", (2, "specs", "light"): "no", (2, "features", "timer"): "true",
        (2, "specs", "empty"): " ", (3, "specs", "light"): "Often", (3, "features", "door"): "yes",
    }


def test_validate_finds_units_and_duplicates(eav):
    rows = eav((1, "specs", 0, "max_load", "5 kg"), (1, "specs", 1, "Max-Load", "6"), (1, "features", 0, "f", "90 mins"), (1, "specs", 2, "g", "A to G"))
    issues = {(r.issue, r.key, r.detail) for r in st.validate(rows).collect()}
    assert issues == {("units_in_values", "max_load", "kg"), ("duplicate_keys", "Max-Load", "max_load"), ("units_in_features", "f", "mins")}
    assert st.validation_summary(st.validate(eav((1, "specs", 0, "a", "5")))).first().passed


def test_standardize_is_stable_on_its_own_output_and_order_free(spark, eav):
    rows = [(p, k, o, key, val) for p in range(12) for k, o, key, val in [
        ("specs", 0, "depth", f"{p} cm"), ("specs", 1, "width", f"{p * 10 + 5} mm"), ("specs", 2, "light", "Yes"),
        ("features", 0, "timer", "Yes"), ("features", 1, "speed", f"{p}00 rpm"),
    ]]
    products = spark.range(12)
    values = rule_table(spark, {"key": ["x"], "value": ["y"], "normalized": ["z"]})
    once = standardize(eav(*rows), products, RuleSet(), values, 10)
    first = sorted(map(tuple, once.collect()))
    shuffled = standardize(eav(*reversed(rows)).repartition(3), products, RuleSet(), values, 10)
    assert sorted(map(tuple, shuffled.collect())) == first
    again = sorted(tuple(r) for r in standardize(once, products, RuleSet(), values, 10).collect())
    assert [(r[0], r[1], r[3], r[4]) for r in again] == [(r[0], r[1], r[3], r[4]) for r in first]


def test_product_rules_shuffle_once(eav):
    rules = RuleSet(merges={"a": "b"}, unit_rules={"w": (["kg"], "w_kg")})
    plan = product_rules(eav((1, "specs", 0, "a", "1")), rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan and "Python" not in plan


def test_map_round_trip(spark):
    products = spark.sql(
        "select 1L as product_id, map('b', '1', 'a', '2') as specs, map('f', 'Yes') as features union all select 2L, null, map('g', 'No')"
    )
    eav = at.to_eav(products)
    assert [(r.kind, r.ord, r.key) for r in eav.where("product_id = 1").orderBy("kind", "ord").collect()] == [("features", 0, "f"), ("specs", 0, "b"), ("specs", 1, "a")]
    back = {r.product_id: (r.specs, r.features) for r in at.from_eav(eav).collect()}
    assert back == {1: ({"b": "1", "a": "2"}, {"f": "Yes"}), 2: ({}, {"g": "No"})}


def test_conflicting_stored_rules_never_double_an_attribute(spark, eav, pairs, tmp_path):
    from shelfwise.plans.standardizing import product_rules, read_rules

    (tmp_path / "1.json").write_text('{"merges": {"a": "b", "x": "y"}, "unit_extractions": {"w": {"units": ["kg"], "new_key": "w_kg"}}}')
    (tmp_path / "2.json").write_text('{"merges": {"a": "c"}, "unit_extractions": {"w": {"units": ["kg"], "new_key": "weight"}}, "deletions": ["gone"]}')
    rules = read_rules(spark, str(tmp_path))
    rows = eav((1, "specs", 0, "a", "v"), (1, "specs", 1, "x", "u"), (1, "specs", 2, "w", "5 kg"), (1, "specs", 3, "gone", "1"))
    assert pairs(product_rules(rows, rules)) == [("c", "v"), ("y", "u"), ("weight", "5")]
    twice = spark.createDataFrame([("k", "v", "n2"), ("k", "v", "n1")], "key string, value string, normalized string")
    assert [(r.key, r.value) for r in st.normalize_values(eav((1, "specs", 0, "k", "v")), twice).collect()] == [("k", "n1")]


def test_validation_works_out_an_extracted_value_once(eav):
    rows = eav((1, "specs", 0, "a", "5 cm x 7 mm"), (1, "specs", 1, "b", "cm"), (1, "features", 0, "c", "2 kg or 3 g"), (1, "specs", 2, "d", None))
    found = st.validate(rows).orderBy("key").collect()
    assert [(r.issue, r.key, r.detail) for r in found] == [("units_in_values", "a", "cm,mm"), ("units_in_features", "c", "kg,g")]
    plan = st.validate(st.extract_units_auto(rows))._jdf.queryExecution().optimizedPlan().toString()
    # Twice for each branch of the union: where the pattern is asked and where its number is taken.
    assert plan.count("RLIKE (?i)\\b(\\d+\\.?\\d*)\\s*rpm\\b") <= 4, plan.count("rpm")
