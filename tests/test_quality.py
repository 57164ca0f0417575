import pytest
from pyspark.sql import functions as F

from attrition.operators import quality as Q


def _report(df, rules):
    return {r["rule"]: (r["observed"], r["success"]) for r in Q.run_rules(df, rules).collect()}


def test_null_semantics_gate_vs_suite(spark):
    df = spark.createDataFrame([("Yes",), (None,), ("No",)], "Churn string")
    gate = Q.rule("in_set", "Churn", "gate", values=["Yes", "No"], nulls_fail=True)
    suite = Q.rule("in_set", "Churn", "suite", values=["Yes", "No"])
    rep = _report(df, [gate, suite, Q.rule("not_null", "Churn", "nn")])
    assert rep["gate"] == (1.0, False)
    assert rep["suite"] == (0.0, True)
    assert rep["nn"] == (1.0, False)


def test_unique_forms(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    rep = _report(df, [Q.rule("unique", "k", "pandas", nulls_fail=True), Q.rule("unique", "k", "expect")])
    assert rep["pandas"] == (2.0, False)   # 4 rows, 2 distinct non-null
    assert rep["expect"] == (2.0, False)   # two rows carry the repeated 'a'
    offenders = Q.duplicate_values(df, "k").collect()
    assert [(r["k"], r["n"]) for r in offenders] == [("a", 2)]


def test_mostly_and_mean_and_empty(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(20000.0,)], "x double")
    rep = _report(df, [Q.rule("between", "x", "b", min=0, max=10000, mostly=0.99),
                       Q.rule("mean_between", "x", "m", min=0, max=100)])
    assert rep["b"] == (1.0, True)
    assert rep["m"][1] is False
    empty = spark.createDataFrame([], "x double")
    rep = _report(empty, [Q.rule("between", "x", "b", min=0, max=1, nulls_fail=True),
                          Q.rule("mean_between", "x", "m", min=0, max=1)])
    assert rep["b"][1] is True and rep["m"][1] is False


def test_kl_zero_for_identical(spark):
    df = spark.createDataFrame([(i % 50,) for i in range(500)], "t int")
    out = Q.kl_divergence(df, df, "t", [0, 10, 20, 30, 40, 50]).first()["kl"]
    assert out == 0.0


def test_assert_valid_raises(spark):
    df = spark.createDataFrame([("Maybe",)], "Churn string")
    import pytest
    with pytest.raises(Q.ValidationError):
        Q.assert_valid(Q.run_rules(df, [Q.rule("in_set", "Churn", "valid_churn", values=["Yes", "No"])]))


def _check_rows(spark):
    rows = [(f"k{i}", "hot" if i % 3 else f"r{i % 5}", None if i % 17 == 0 else i % 9, float(i % 50), "YN"[i % 2]) for i in range(900)]
    return spark.createDataFrame(rows, "id string, run string, n int, x double, flag string")


CHECKS = [Q.rule("not_null", "n"), Q.rule("not_null", "n", "mostly_n", mostly=0.9), Q.rule("in_set", "flag", values=["Y"]),
          Q.rule("in_set", "n", "gate_n", values=list(range(9)), nulls_fail=True), Q.rule("between", "x", min=0, max=48),
          Q.rule("between", "x", "mostly_x", min=0, max=48, mostly=0.97), Q.rule("length_equal", "flag", length=1),
          Q.rule("mean_between", "x", min=20, max=30), Q.rule("row_count", None, "rows", min=10, max=1000),
          Q.rule("rate", "flag", "rate", value="Y", min=0.4, max=0.6),
          Q.rule("columns_match", None, "columns", columns=["id", "n", "x", "flag"]),
          Q.rule("kl", "x", edges=[0, 10, 20, 30, 40], threshold=0.1)]


def test_merged_states_equal_a_full_run(spark):
    from attrition.operators import check_states as CS
    df = _check_rows(spark)
    ref = df.filter("x > 5").drop("run")
    key = lambda r: r["rule"]
    want = sorted((tuple(r) for r in Q.run_rules(df.drop("run"), CHECKS, ref).collect()))
    states = CS.check_states(df.filter("id < 'k5'"), CHECKS, "run").unionByName(CS.check_states(df.filter("id >= 'k5'"), CHECKS, "run"))
    got = CS.report_from_states(states, CHECKS, reference=CS.check_states(ref, CHECKS)).collect()
    assert sorted(tuple(r)[:5] for r in got) == want and all(r.error is None for r in got)
    # folding states first changes nothing; one report a run equals the run's own
    folded = CS.merge_check_states(states, CHECKS)
    assert folded.count() == len(CHECKS)
    again = CS.report_from_states(folded, CHECKS, reference=CS.check_states(ref, CHECKS)).collect()
    assert sorted(again, key=key) == sorted(got, key=key)
    one = [r for r in CHECKS if r.kind != "kl"]
    by_run = CS.report_from_states(states, one, "run").filter("run = 'hot'").drop("run", "error").collect()
    assert sorted(map(tuple, by_run)) == sorted(map(tuple, Q.run_rules(df.filter("run = 'hot'").drop("run"), one).collect()))


def test_uniqueness_states_its_error(spark):
    from attrition.operators import check_states as CS
    df = spark.range(40_000).select((F.col("id") % 4).cast("string").alias("run"), F.col("id").cast("string").alias("k"),
                                    (F.col("id") % 7).alias("few"), (F.col("id") % 20_000).alias("twice"),
                                    F.when(F.col("id") > 5, F.col("id")).alias("gaps"))
    rules = [Q.rule("unique", "k"), Q.rule("unique", "twice"), Q.rule("unique_ratio", "few", min=0.0, max=0.5),
             Q.rule("unique", "gaps", "gate", nulls_fail=True), Q.rule("unique", "gaps")]
    r = {x.rule: x for x in CS.report_from_states(CS.check_states(df, rules, "run"), rules).collect()}
    assert r["unique:k"].success and r["unique:k"].observed <= r["unique:k"].error < 1100
    assert not r["unique:twice"].success and abs(r["unique:twice"].observed - 20_000) <= r["unique:twice"].error
    assert r["unique_ratio:few"].observed == round(7 / 40_000, 6) and r["unique_ratio:few"].success
    assert not r["gate"].success and r["unique:gaps"].success


def test_check_states_of_nothing_and_of_nulls(spark):
    from attrition.operators import check_states as CS
    rules = [*CHECKS, Q.rule("unique", "id"), Q.rule("unique_ratio", "n", min=0.0, max=0.5)]
    plain = [r for r in CHECKS if r.kind != "kl"]
    none = _check_rows(spark).drop("run").limit(0)
    for df in (none, spark.createDataFrame([(None,) * 4], none.schema)):
        states = CS.check_states(df, rules)
        got = CS.report_from_states(states, rules, reference=states).collect()
        assert len(got) == len(rules)
        want = {r.rule: r.success for r in Q.run_rules(df, plain).collect()}
        assert {r.rule: r.success for r in got if r.rule in want} == want
    with pytest.raises(ValueError):
        CS.check_states(none, [CHECKS[0], CHECKS[0]])
    with pytest.raises(ValueError):
        CS.report_from_states(states, rules)
