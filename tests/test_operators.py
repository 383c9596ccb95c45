import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlake.config import DEFAULT_METHODOLOGY as M, account_rules
from ledgerlake.operators.aggregate import first_non_null, lenient_sum, strict_sum
from ledgerlake.operators.classify import classify, dashboard_facts, normalize_code_keys
from ledgerlake.operators.joins import (gap_fill, grid_template, missing_keys, null_safe_join, occurrence_join,
                                        occurrence_number)
from ledgerlake.operators.measures import (ReferenceSeries, ReferenceSeriesError, augment_monetary,
                                           reference_checks, select_measure, validate_reference_table,
                                           validate_references)
from ledgerlake.operators.periods import annualize, complete_years, extrapolate_year, parse_dates_uniform, rebase
from ledgerlake.operators.quality import domain_check, duplicate_keys, key_profile, reconcile
from ledgerlake.operators.reshape import has_data, literal_frame, unpivot
from ledgerlake.operators.windows import running_balance
from tests.conftest import rows


def test_strict_and_lenient_sums(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("c", 2.0), ("c", 3.0)], "k string, v double")
    out = df.groupBy("k").agg(strict_sum("v").alias("s"), lenient_sum("v").alias("l"))
    assert rows(out) == [("a", None, 1.0), ("b", None, 0.0), ("c", 5.0, 5.0)]


def test_first_non_null_follows_order_and_skips_nulls(spark):
    df = spark.createDataFrame([("g", None, 1), ("g", "second", 3), ("g", "first", 2), ("h", None, 1)],
                               "k string, label string, row int")
    out = df.groupBy("k").agg(first_non_null("label", "row").alias("f"))
    assert rows(out) == [("g", "first"), ("h", None)]


def test_null_safe_join_matches_null_keys(spark):
    left = spark.createDataFrame([("A", None, 1.0), ("B", 1, 2.0)], "h string, s int, v double")
    right = spark.createDataFrame([("A", None, "total A"), ("B", 2, "other")], "h string, s int, label string")
    out = null_safe_join(left, right, ["h", "s"], "left")
    assert rows(out, "h", "s", "label") == [("A", None, "total A"), ("B", 1, None)]
    semi = null_safe_join(left, right, ["h", "s"], "left_semi")
    assert rows(semi, "h") == [("A",)]


def test_occurrence_join_pairs_nth_duplicates(spark):
    src = spark.createDataFrame([("s", "Ventas", 1, 10.0), ("s", "Ventas", 5, 20.0), ("s", "Otros", 3, 1.0)],
                                "sheet string, concepto string, row int, v double")
    tpl = spark.createDataFrame([("s", "Ventas", 2, "A1"), ("s", "Ventas", 7, "A2")],
                                "sheet string, concepto string, row int, code string")
    out = occurrence_join(src.withColumnRenamed("row", "r1"), tpl.withColumnRenamed("row", "r2"),
                          ["sheet", "concepto"], ["r1"], ["r2"])
    assert rows(out, "v", "code") == [(10.0, "A1"), (20.0, "A2")]


def test_classify_rules_and_nulls(spark):
    df = spark.createDataFrame([
        ("X", "A", None, None), ("X", "B", 2, 1), ("X", "B", None, 1), ("X", "D", 1, 4), ("X", "D", 1, 12),
        ("ANCAP", "F", 1, 3), ("UTE", "F", 1, 3), ("X", "H", 0, 0), ("X", "I", 5, 1), ("X", None, 1, 1),
    ], "empresa string, header_code string, sub_header_code int, item_code int")
    out = classify(df, account_rules())
    assert rows(out, "empresa", "header_code", "fill_col", "facet_col") == [
        ("ANCAP", "F", "Variación de Stocks", "Inversiones"),
        ("UTE", "F", "Formación de Capital", "Inversiones"),
        ("X", "A", "Ingresos", "Ingresos"),
        ("X", "B", "Compras", "Gastos"),
        ("X", "D", "BPS", "Impuestos y Transferencias"),
        ("X", "H", "Resultado", "Resultado"),
    ]


def test_normalize_code_keys_rewrites_both_codes_from_original_values(spark):
    df = spark.createDataFrame([("A", None, None), ("F", None, None), ("F", 2, 0), ("H", 3, 7), ("B", None, None),
                                ("A", 1, None)], "header_code string, sub_header_code int, item_code int")
    out = normalize_code_keys(df)
    assert rows(out) == [("A", 0, 0), ("A", 1, None), ("B", None, None), ("F", 0, 0), ("F", 0, 0), ("H", 0, 0)]
    assert normalize_code_keys(df.drop("item_code")).columns == ["header_code", "sub_header_code"]


def test_dashboard_keep_rule(spark):
    df = spark.createDataFrame([
        ("X", "A", 1, 0, "Ingresos", "Ventas", 100.0),     # keep
        ("X", "A", 1, 3, "Ingresos", "Detalle", 100.0),    # drop
        ("X", "B", 2, 4, "Gastos", "Compras x", 50.0),     # keep (item != 0)
        ("ANCAP", "F", 1, 3, "Inversiones", "Stock", 9.0),  # keep (ANCAP, sub != 0)
        ("UTE", "F", 1, 3, "Inversiones", "Obra", 9.0),     # drop (not ANCAP, sub != 0)
        ("X", "H", 0, 0, "Resultado", "Res. neto", 5.0),    # keep, label overridden
        ("X", "H", 0, 0, "Resultado", "Res. neto", 0.5),    # below threshold
        ("X", "A", None, 0, "Ingresos", "Nulo", 100.0),     # NULL condition -> dropped
    ], "empresa string, header_code string, sub_header_code int, item_code int, facet_col string, label string, "
       "valor double")
    out = dashboard_facts(df)
    assert rows(out, "empresa", "label", "keep") == [("ANCAP", "Stock", True), ("X", "Compras x", True),
                                                     ("X", "Resultado", True), ("X", "Ventas", True)]


def test_running_balance_january_anchor(spark):
    d = dt.date
    df = spark.createDataFrame([
        ("E", d(2025, 1, 1), 10.0, 1000.0), ("E", d(2025, 2, 1), 20.0, None), ("E", d(2025, 3, 1), None, None),
        ("G", d(2025, 2, 1), 5.0, None),
    ], "e string, fecha date, mov double, opening double")
    out = running_balance(df.repartition(3), "e", "fecha", "mov", "opening")
    # January shows the opening; February deducts January AND February
    assert rows(out, "e", "fecha", "saldo") == [
        ("E", d(2025, 1, 1), 1000.0), ("E", d(2025, 2, 1), 970.0), ("E", d(2025, 3, 1), 970.0),
        ("G", d(2025, 2, 1), None)]


def test_periods_complete_years_rebase_extrapolate(spark):
    monthly = spark.createDataFrame([(2023, m, 1.0 * m) for m in range(1, 13)] +
                                    [(2024, m, 2.0 * m) for m in range(1, 13)] +
                                    [(2025, m, 9.0) for m in range(1, 4)], "year int, month int, v double")
    done = complete_years(monthly, "year", "month", 12)
    assert rows(done) == [(2023,), (2024,)]
    annual = annualize(monthly, "year", "v", "mean", out="m", complete=done)
    idx = rebase(annual, "year", "m", 2024, "idx")
    assert rows(idx, "year", "idx") == [(2023, 50.0), (2024, 100.0)]
    gdp = annualize(monthly, "year", "v", "sum", out="g", complete=done)
    ext = extrapolate_year(gdp, "year", "g", 2025, 0.025)
    assert rows(ext) == [(2023, 78.0), (2024, 156.0), (2025, 156.0 * 1.025)]
    # appended only if absent
    assert rows(extrapolate_year(ext, "year", "g", 2025, 0.5)) == rows(ext)


def test_parse_dates_uniform_picks_one_format(spark):
    df = spark.createDataFrame([(1, "03-04-2020"), (2, "2020-04-05"), (3, "06-04-2020")], "row int, t string")
    out = parse_dates_uniform(df, "t", "row", "d")
    assert rows(out, "row", "d") == [(1, dt.date(2020, 4, 3)), (2, None), (3, dt.date(2020, 4, 6))]


def refs_fixture(spark, years=(2024, 2025)):
    index = {2024: 100.0, 2025: 110.0}
    gdp = {2024: 1000.0, 2025: 2000.0}
    rate = {2024: 40.0, 2025: 50.0}
    mk = lambda d, col: spark.createDataFrame([(y, d[y]) for y in years], f"year int, {col} double")
    return ReferenceSeries(mk(index, M.index_value), mk(gdp, M.gdp_value), mk(rate, M.rate_value))


def test_augment_monetary_hand_computed(spark):
    facts = spark.createDataFrame([(2024, 100.0), (2025, 220.0)], "year int, valor double")
    out = augment_monetary(facts, "valor", refs_fixture(spark))
    got = {r["year"]: r for r in out.collect()}
    assert got[2024]["valor_2024"] == pytest.approx(100.0) and got[2025]["valor_2024"] == pytest.approx(200.0)
    assert got[2024]["valor_usd"] == pytest.approx(2.5) and got[2025]["valor_usd"] == pytest.approx(4.4)
    assert got[2024]["valor_pct_pib"] == pytest.approx(0.1) and got[2025]["valor_pct_pib"] == pytest.approx(0.11)
    assert out.columns == ["year", "valor", "valor_2024", "valor_pct_pib", "valor_usd"]


def test_augment_monetary_missing_year_fails(spark):
    facts = spark.createDataFrame([(2024, 100.0), (2025, 220.0)], "year int, valor double")
    refs = refs_fixture(spark, years=(2024,))
    with pytest.raises(PySparkException, match="missing required years: 2025"):
        augment_monetary(facts, "valor", refs).collect()
    with pytest.raises(ReferenceSeriesError, match="missing required years: 2025"):
        validate_references(refs, M, facts)
    lenient = augment_monetary(facts, "valor", refs, on_missing="null")
    assert rows(lenient, "year", "valor_usd") == [(2024, 2.5), (2025, None)]


def test_reference_table_validation_messages(spark):
    dup = spark.createDataFrame([(2024, 1.0), (2024, 2.0)], "year int, v double")
    with pytest.raises(ReferenceSeriesError, match="duplicate years"):
        validate_reference_table(dup, "s", "v")
    neg = spark.createDataFrame([(2024, -1.0)], "year int, v double")
    with pytest.raises(ReferenceSeriesError, match="strictly positive"):
        validate_reference_table(neg, "s", "v")
    with pytest.raises(ReferenceSeriesError, match="missing columns: w"):
        validate_reference_table(neg, "s", "w")
    nul = spark.createDataFrame([(2024, None)], "year int, v double")
    with pytest.raises(ReferenceSeriesError, match="missing values"):
        validate_reference_table(nul, "s", "v")


def test_reference_checks_rows(spark):
    facts = spark.createDataFrame([(2024,), (2025,)], "year int")
    out = reference_checks(refs_fixture(spark, years=(2024,)), facts)
    failed = {(r["series"], r["check"]): r["detail"] for r in out.collect() if not r["passed"]}
    assert set(failed) == {("ipc_anual", "required_years"), ("pib_nominal_anual", "required_years"),
                           ("dolar_promedio_anual", "required_years")}
    assert failed[("ipc_anual", "required_years")].endswith("missing required years: 2025")


def test_select_measure_allow_list(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "valor double, valor_usd double")
    assert select_measure(df, "valor_usd", ["valor", "valor_usd"]).first()["ejecutado_select"] == 2.0
    with pytest.raises(ValueError):
        select_measure(df, "valor_x", ["valor", "valor_usd"])


def test_quality_operators(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "k int, m int")
    assert rows(duplicate_keys(df, ["k", "m"])) == [(1, 1, 2)]
    p = key_profile(df, ["k"]).first()
    assert (p["rows"], p["keys"], p["duplicated_keys"]) == (3, 2, 1)
    a = spark.createDataFrame([(2024, 100.0), (2025, 200.0)], "year int, v double")
    b = spark.createDataFrame([(2024, 100.0), (2025, 190.0), (2026, 1.0)], "year int, v double")
    r = reconcile(a, b, ["year"], "v").first()
    assert (r["rows_actual"], r["rows_expected"], r["rows_unmatched"]) == (2, 3, 1)
    assert r["mean_rel_diff"] == pytest.approx(10.0 / 190.0) and r["within_tolerance"] is False
    ev = spark.createDataFrame([("click",), ("oops",)], "t string")
    assert rows(domain_check(ev, "t", ["click", "view"])) == [("t", "oops", "unexpected"), ("t", "view", "missing")]


def test_grid_and_gap_fill(spark):
    labels = spark.createDataFrame([("L1",), ("L2",)], "label string")
    t = grid_template(labels, {"month": [1, 2, 3], "tipo": ["Ejecutado", "Firmado"]})
    assert t.count() == 12
    facts = spark.createDataFrame([("L1", 2, "Firmado", 5.0)], "label string, month int, tipo string, valor double")
    g = gap_fill(t, facts, ["label", "month", "tipo"], {"valor": 0.0})
    assert g.where("observed").count() == 1 and g.where("valor = 0").count() == 11


def test_reshape(spark):
    df = spark.createDataFrame([("a", 0.0, None), ("b", None, 2.0), ("c", None, None)], "k string, m1 double, m2 double")
    assert rows(df.where(has_data(["m1", "m2"])), "k") == [("b",)]
    long = unpivot(df, ["k"], ["m1", "m2"], "mes", "v")
    assert long.count() == 6  # NULLs kept
    lf = literal_frame(spark, [(1, "x"), (2, None)], [("i", "int"), ("s", "string")])
    assert rows(lf) == [(1, "x"), (2, None)]
    assert literal_frame(spark, [], [("i", "int")]).count() == 0


def test_missing_keys(spark):
    req = spark.createDataFrame([(2024,), (2025,)], "year int")
    have = spark.createDataFrame([(2024,)], "year int")
    assert rows(missing_keys(req, have, ["year"])) == [(2025,)]


def numbered_like_a_window(df, order, hot_rows, by=("g",)):
    """Tasks that the group "hot" is spread over; its numbers are checked."""
    from pyspark.sql import Window
    df.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = occurrence_number(df, by, order, "occ", hot_rows=hot_rows)
        spread = got.withColumn("p", F.spark_partition_id()).where("g = 'hot'").groupBy("p").agg(F.max("occ")).collect()
        out = rows(got.withColumn("o", F.col("o").cast("string")))   # NaN compares as text
    finally:
        df.sparkSession.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = df.withColumn("occ", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    assert out == rows(want.withColumn("o", F.col("o").cast("string")))
    return len(spread)


def test_occurrence_number_splits_a_hot_group(spark):
    """One group holds a third of all rows, with ties, NULL groups and NULL
    order values; the numbers are those of a plain window."""
    hot = [("hot", i % 40, i) for i in range(3000)]
    cold = [(f"g{i % 50}", i % 3, i) for i in range(6000)]
    odd = [(None, i, i) for i in range(10)] + [("g1", None, -i) for i in range(1, 5)]
    df = spark.createDataFrame(hot + cold + odd, "g string, o int, tie int")
    assert numbered_like_a_window(df, ["o", "tie"], 200) > 1
    assert numbered_like_a_window(df, ["o", "tie"], 10 ** 6) == 1
    for kind in ("string", "date", "boolean", "double", "bigint", "decimal(12,2)", "timestamp"):
        one = df.withColumn("o", F.date_add(F.lit("2020-01-01").cast("date"), "o").cast(kind) if kind in ("date", "timestamp")
                            else F.col("o").cast(kind))
        numbered_like_a_window(one, ["o", "tie"], 200)


def test_occurrence_number_splits_ties(spark):
    """The hot group ties on the first order column - one value, a long common
    text, NULL, NaN - or on all of them: later columns and the row part it."""
    base = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 70)).alias("g"),
                                    F.col("id").alias("tie"))
    for tied in (F.lit(7), F.lit(2 ** 60 + 1).cast("bigint"), F.lit(None).cast("int"), F.lit(float("nan")),
                 F.when(F.col("tie") % 5 == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf"))),
                 F.when(F.col("tie") % 2 == 0, F.lit(None).cast("bigint")).otherwise(F.lit(2 ** 60) + F.col("tie") % 3)):
        assert numbered_like_a_window(base.withColumn("o", tied), ["o", "tie"], 100) > 1
    text = F.concat(F.lit("the same first words"), F.col("tie").cast("string"))
    numbered_like_a_window(base.withColumn("o", text), ["o"], 100)
    got = occurrence_number(base.withColumn("o", F.lit(1)), ["g"], ["o"], "occ", hot_rows=100)
    per = got.groupBy("g").agg(F.count("occ").alias("n"), F.countDistinct("occ").alias("d"), F.max("occ").alias("m"),
                               F.min("occ").alias("lo")).collect()
    assert all(r["n"] == r["d"] == r["m"] and r["lo"] == 1 for r in per)


def test_occurrence_join_reads_each_side_once(spark):
    """Without a large group the plan is one scan and one window a side."""
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k int, o int")
    plan = occurrence_number(df, ["k"], ["o"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and "Join" not in plan


def test_reconcile_frames_per_column(spark):
    from ledgerlake.operators.quality import reconcile_frames
    a = spark.createDataFrame([(1, 100.0, "x", 5), (2, 200.0, "y", None)], "k int, v double, t string, w int")
    e = spark.createDataFrame([(1, 100.0, "x", 5), (2, 190.0, "z", None)], "k int, v double, t string, w int")
    got = {r["column"]: r for r in reconcile_frames(a, e, ["k"]).collect()}
    assert got["v"]["mean_rel_diff"] == pytest.approx(10.0 / 190.0) and not got["v"]["within_tolerance"]
    assert got["t"]["mismatches"] == 1 and got["t"]["kind"] == "text"
    assert got["w"]["within_tolerance"] and got["w"]["mean_rel_diff"] == 0.0
    same = reconcile_frames(a, a.drop("w"), ["k"]).collect()
    assert {r["column"]: r["kind"] for r in same} == {"v": "numeric", "t": "text", "w": "missing"}


def test_augment_constant_year_uses_no_join(spark):
    facts = spark.createDataFrame([(2025, 220.0), (2025, 110.0)], "year int, valor double")
    out = augment_monetary(facts, "valor", refs_fixture(spark), constant_year=2025)
    assert rows(out, "valor", "valor_2024", "valor_usd") == [(110.0, pytest.approx(100.0), pytest.approx(2.2)),
                                                             (220.0, pytest.approx(200.0), pytest.approx(4.4))]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(PySparkException, match="missing required years: 2025"):
        augment_monetary(facts, "valor", refs_fixture(spark, years=(2024,)), constant_year=2025).collect()


def test_add_deflators_checks_types(spark):
    from ledgerlake.operators.measures import add_deflators
    ok = spark.createDataFrame([(2025, 220.0)], "year int, ejecutado double")
    r = add_deflators(ok, refs_fixture(spark)).first()
    assert r["ejecutado_2024"] == pytest.approx(200.0) and r["ejecutado_usd"] == pytest.approx(4.4)
    bad = spark.createDataFrame([("2025", 220.0)], "year string, ejecutado double")
    with pytest.raises(ValueError, match="numeric column named 'year'"):
        add_deflators(bad, refs_fixture(spark))


def test_reconcile_follows_the_rule(spark):
    """Differences average over the rows that differ; NULL keys match; a value
    missing on one side and an expected zero are mismatches."""
    from ledgerlake.operators.quality import reconcile_frames
    many = [(i, 1.0) for i in range(1000)]
    make = lambda xs: spark.createDataFrame(xs, "k int, v double")
    cases = {
        "one off": (make(many + [(1000, 1.1)]), make(many + [(1000, 1.0)]), 0.1, False),
        "zero expected": (make([(1, 5.0)]), make([(1, 0.0)]), 5.0, False),
        "null value": (make([(1, None)]), make([(1, 1.0)]), 0.0, False),
        "nan value": (make([(1, float("nan"))]), make([(1, 1.0)]), 0.0, False),
        "null key": (make([(None, 2.0), (1, 1.0)]), make([(None, 2.0), (1, 1.0)]), 0.0, True),
        "both null": (make([(1, None)]), make([(1, None)]), 0.0, True),
    }
    for name, (a, e, diff, ok) in cases.items():
        r = reconcile(a, e, ["k"], "v").first()
        assert (round(r["mean_rel_diff"], 9), r["within_tolerance"], r["rows_unmatched"]) == (diff, ok, 0), name
        f = reconcile_frames(a, e, ["k"]).first()
        assert (round(f["mean_rel_diff"], 9), f["within_tolerance"]) == (diff, ok), name


def test_parsing_edges(spark):
    import datetime as dt
    from ledgerlake.functions.dates import parse_date, serial_to_date
    from ledgerlake.functions.numeric import lenient_double
    from ledgerlake.operators.reshape import has_data
    df = spark.createDataFrame([(t,) for t in ("12d", "3f", "NaN", "1e12", " 7.5 ", "-1e2", "", None, "Infinity")], "t string")
    got = [r[0] for r in df.select(lenient_double("t")).collect()]
    assert got == [None, None, None, 1e12, 7.5, -100.0, None, None, None]
    days = [r[0] for r in df.select(serial_to_date("t")).collect()]
    assert days[:4] == [None] * 4 and days[4] == dt.date(1900, 1, 6)
    d = spark.createDataFrame([("2024-01-02 00:00:00",), ("02-01-2024",), ("x 2024-01-02",)], "t string")
    assert [r[0] for r in d.select(parse_date("t")).collect()] == [dt.date(2024, 1, 2)] * 2 + [None]
    n = spark.createDataFrame([(float("nan"), None), (0.0, 1.0)], "a double, b double")
    assert [r[0] for r in n.select(has_data(["a", "b"])).collect()] == [False, True]


def test_domain_check_reports_null(spark):
    df = spark.createDataFrame([("a",), (None,)], "t string")
    assert rows(domain_check(df, "t", ["a", "b"])) == [("t", "b", "missing"), ("t", None, "unexpected")]


def test_reconcile_pairs_duplicate_keys_one_to_one(spark):
    from ledgerlake.operators.quality import reconcile_frames
    a = spark.createDataFrame([(1, 10.0), (1, 20.0), (1, 30.0)], "k int, v double")
    e = spark.createDataFrame([(1, 30.0), (1, 10.0), (1, 20.0)], "k int, v double")
    r = reconcile(a, e, ["k"], "v").first()
    assert (r["rows_actual"], r["rows_expected"], r["rows_unmatched"]) == (3, 3, 0)  # not 9 pairs
    assert r["within_tolerance"]
    f = reconcile_frames(a, e.limit(2).union(spark.createDataFrame([(1, 99.0)], "k int, v double")), ["k"])
    assert f.first()["rows_actual"] == 3 and not f.first()["within_tolerance"]


def brute_pairs(a, e):
    """Rows of two frames (key, value) paired as :func:`reconcile` says."""
    import collections
    sort = lambda vs: sorted(vs, key=lambda v: (v is not None, v or 0))
    out = []
    for k in {k for k, _ in a + e}:
        left, right = (collections.Counter(v for kk, v in side if kk == k) for side in (a, e))
        out += [(v, v, True) for v in (left & right).elements()]
        x, y = sort((left - right).elements()), sort((right - left).elements())
        n = min(len(x), len(y))
        out += [(p, q, True) for p, q in zip(x, y)] + [(None, None, False)] * (len(x) + len(y) - 2 * n)
    differ = [(p, q) for p, q, both in out if both and p is not None and q is not None and p != q]
    size = sum(abs(q) for _, q in differ)
    diff = sum(abs(p - q) for p, q in differ)
    mean = 0.0 if not differ else diff / size if size / len(differ) > 1e-6 else diff / len(differ)
    return (len(a), len(e), sum(not b for *_, b in out), sum(b and (p is None) != (q is None) for p, q, b in out), round(mean, 9))


def test_reconcile_against_brute_force(spark):
    """Repeated, NULL and one-sided keys; equal rows pair off, the rest of a
    key pairs by value; a hot key holds a third of the rows."""
    import random
    from ledgerlake.operators.quality import reconcile_frames
    for seed in range(4):
        rng = random.Random(seed)
        draw = lambda n: [(rng.choice([None, 1, 1, 1, *range(2, 30)]), rng.choice([None, 0.0, *map(float, range(1, 9))]))
                          for _ in range(n)]
        a = draw(120)
        e = [r for r in a if rng.random() < 0.9] + draw(seed * 10)
        x, y = (spark.createDataFrame(s, "k int, v double") for s in (a, e))
        r = reconcile(x, y, ["k"], "v").first()
        want = brute_pairs(a, e)
        assert (r["rows_actual"], r["rows_expected"], r["rows_unmatched"], r["null_mismatches"],
                round(r["mean_rel_diff"], 9)) == want
        f = reconcile_frames(x, y, ["k"]).first()
        assert (f["rows_actual"], f["rows_expected"], f["rows_unmatched"], f["mismatches"], round(f["mean_rel_diff"], 9)) == want
    none = spark.createDataFrame([], "k int, v double")
    assert tuple(reconcile(none, none, ["k"], "v").first()) == (0, 0, 0, 0, 0.0, True)


def test_canonicalize_by_table_never_duplicates(spark):
    from ledgerlake.operators.joins import canonicalize_by_table
    df = spark.createDataFrame([(1, "  otros   INGRESOS "), (2, "ventas")], "id int, label string")
    syn = spark.createDataFrame([("otros ingresos", "Otros Ingresos"), ("OTROS ingresos", "Otros ingresos")],
                                "key string, canonical string")
    out = canonicalize_by_table(df, "label", syn)
    assert rows(out, "id", "label") == [(1, "Otros Ingresos"), (2, "ventas")]
