"""Operators on small fixtures with known answers."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarrystone import contracts as C
from quarrystone.functions import scalars as S
from quarrystone.operators import documents, duplicates, normalize, quality, reconcile, signals, tfidf
from quarrystone.sources import pipe


def test_names_families_and_roles():
    assert C.normalized(["MDR REPORT KEY", "a--B", "_source_role"]) == ["mdr_report_key", "a_b", "_source_role"]
    with pytest.raises(ValueError):
        C.normalized(["MDR_REPORT_KEY", "MDR REPORT KEY"])
    assert C.detect_family("x/mdrfoi2020.txt", ["MDR_REPORT_KEY", "DATE_RECEIVED", "EVENT_TYPE"]).name == "master"
    with pytest.raises(ValueError):
        C.detect_family("foidev.txt", ["MDR_REPORT_KEY"])
    with pytest.raises(ValueError):
        C.detect_family("patientdevice.txt", [])
    assert [C.detect_role(n) for n in ("deviceChange.zip", "x/device_ADD.txt", "device.zip")] == ["change", "add", "base"]
    assert C.valid_identifier("a.b-1") and not C.valid_identifier("..") and not C.valid_identifier("a/b")


def test_normalize(spark):
    bronze = spark.createDataFrame([("1", " NI ", "01/02/2025"), ("2", "  ", "13/40/2025"), ("3", None, ""), ("4", "x", " 2025/02/03 ")], "`MDR REPORT KEY` string, EVENT_TYPE string, DATE_RECEIVED string")
    rows = {r.mdr_report_key: r for r in normalize.normalize_bronze(bronze, C.FAMILIES["master"], "s").collect()}
    assert rows["1"].event_type == " NI " and rows["2"].event_type is None and rows["3"].event_type is None
    assert [rows[k].date_received for k in "1234"] == [dt.date(2025, 1, 2), None, None, dt.date(2025, 2, 3)]
    assert rows["2"].date_received_raw == "13/40/2025" and rows["3"].date_received_raw is None
    silver = normalize.normalize_bronze(bronze, C.FAMILIES["master"], "s")
    assert silver.agg(normalize.failed_dates(silver, C.FAMILIES["master"].dates)).first()[0] == 1


def test_content_hash_is_unambiguous(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("<NULL>", None), (None, "<NULL>")], "a string, b string")
    assert rows.select(S.content_hash([F.col("a"), F.col("b")]).alias("h")).distinct().count() == 4


def roles(spark):
    data = [("1", "a", "base", 1), ("2", "b", "base", 2), ("5", "c", "base", 3), ("2", "b", "add", 4), ("3", "d", "add", 5), ("1", "e", "change", 6), ("4", "f", "change", 7), ("4", "f", "change", 8), ("5", "g", "change", 9), ("5", "h", "change", 10)]
    return spark.createDataFrame(data, "k string, record_content_hash string, _source_role string, n int")


def test_reconcile_precedence_collapse_and_quarantine(spark):
    rows = roles(spark)
    won = {r.k: (r._source_role, r.record_content_hash) for r in reconcile.selected(rows, ["k"], order="n").collect()}
    assert won == {"1": ("change", "e"), "2": ("add", "b"), "3": ("add", "d"), "4": ("change", "f"), "5": ("base", "c")}
    assert sorted(r.record_content_hash for r in reconcile.conflicts(rows, ["k"], order="n").collect()) == ["g", "h"]
    got = {r._source_role: r for r in reconcile.stats(rows, ["k"], order="n").collect()}
    assert (got["add"].inserted, got["add"].updated, got["add"].unchanged) == (1, 0, 1)
    assert (got["change"].inserted, got["change"].updated, got["change"].collapsed, got["change"].quarantined_rows, got["change"].quarantined_keys) == (1, 1, 1, 2, 1)
    assert got["base"].superseded == 2 and reconcile.selected_rows(reconcile.stats(rows, ["k"], order="n")).first()[0] == 5
    with pytest.raises(ValueError):
        reconcile.reconcile(rows, ["k"], quarantine=False, order="n")


def test_reconcile_shuffles_rows_by_key_once(spark):
    plan = reconcile.selected(roles(spark), ["k"], order="n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 2


def counted(spark, seen, rejected):
    return spark.createDataFrame([(seen, seen - rejected, rejected)], "seen long, accepted long, rejected long")


@pytest.mark.parametrize("seen,rejected,passed,level", [(200, 0, True, "warning"), (200, 1, False, "warning"), (201, 1, False, "warning"), (100, 1, False, "blocking"), (0, 0, True, "warning")])
def test_reject_limits(spark, seen, rejected, passed, level):
    row = quality.reject_fraction(counted(spark, seen, rejected)).first()
    assert (row.passed, row.level) == (passed, level)


def test_drift_orphans_and_gate(spark):
    numbers = spark.range(100).select(F.col("id").cast("string").alias("mdr_report_key"))
    assert not quality.drift(numbers.limit(89), numbers).first().passed and quality.drift(numbers.limit(90), numbers).first().passed
    parents = numbers.where("mdr_report_key > 0")
    assert quality.orphans(parents, parents).first().passed
    one = quality.orphans(numbers.union(numbers.limit(1)).union(numbers.select(F.lit(""))), parents)
    assert (one.first().passed, one.first().level, one.first().denominator) == (False, "blocking", 101)
    results = quality.report({"a|x": one, "b": quality.required_tables(spark, list(C.FAMILIES))})
    gate = quality.gate(results).first()
    assert (gate.checks, gate.blocking, gate.promotable) == (2, 1, False) and "FAIL" in quality.markdown(results)
    assert quality.uniqueness(spark.createDataFrame([("1",), ("1",), (None,)], "k string"), ["k"]).first().numerator == 1


def test_volume_change_flags(spark):
    months = [dt.date(2024 + m // 12, m % 12 + 1, 1) for m in range(15)]

    def reports(code, per_month, last):
        return [(code, m, last if m == months[-1] else per_month) for m in months for _ in range(last if m == months[-1] else per_month)]

    rows = [(c, m) for c, m, _ in reports("JUMP", 2, 7) + reports("CALM", 2, 6) + reports(None, 1, 1)] + [("GONE", months[0]), ("OLD", dt.date(2023, 1, 1))]
    frame = spark.createDataFrame([(str(i), c, m, "death") for i, (c, m) in enumerate(rows)], "report_id string, product_code string, date_received date, reported_severity_category string")
    monthly, bounds = signals.monthly_cohorts(frame), signals.window_bounds(frame, dt.date(2025, 6, 1))
    got = {r.product_code: r for r in signals.checked_volume_change(monthly, bounds).collect()}
    assert set(got) == {"JUMP", "CALM", None, "GONE"}
    assert (got["JUMP"].additional_reports_vs_baseline, got["JUMP"].baseline_mad_monthly_reports, got["CALM"].minimum_count_increase_met) == (5.0, 0.0, False)
    assert got["JUMP"].robust_z_score == pytest.approx(5 / 3) and not got["JUMP"].report_volume_change_flag
    assert got["GONE"].baseline_median_monthly_reports == 0 and got["GONE"].recent_total_reports == 0
    gap = monthly.where(F.col("month") != F.lit(months[4]))
    assert signals.missing_months(gap, bounds).count() == 1
    with pytest.raises(ValueError):
        signals.checked_volume_change(gap, bounds)


def test_documents_and_corpus(spark):
    reports = spark.createDataFrame([("1", "D", "2025-01-01", "s"), ("2", "M", "bad", "s")], "mdr_report_key string, event_type string, date_received string, dataset_snapshot_id string")
    devices = spark.createDataFrame([("1", "1", "ZZZ", "Bravo", "Mfg B"), ("1", "2", "ABC", "Alpha", "Mfg A"), ("1", "3", "ABC", " ", None)], "mdr_report_key string, device_sequence_no string, device_report_product_code string, brand_name string, manufacturer_d_name string")
    texts = [("1", "11", "N", "second", "a", "3"), ("1", "10", "N", "first\n narrative", "a", "2"), ("1", "10", "N", "later copy", "b", "1"), ("1", "x", "N", " \t ", "a", "9")]
    narratives = spark.createDataFrame(texts, "mdr_report_key string, mdr_text_key string, text_type_code string, foi_text string, _source_filename string, _source_line_number string")
    rows = documents.report_documents(reports, devices, narratives)
    one = documents.lookup(documents.nested(rows), "1").first()
    assert (one.product_codes, one.brand_names, one.manufacturers) == (["ABC", "ZZZ"], ["Alpha", "Bravo"], ["Mfg A", "Mfg B"])
    assert [n.evidence_id for n in one.narratives] == ["narrative:x", "narrative:10", "narrative:11"]
    made = documents.modeling_documents(documents.nested(rows)).collect()
    assert [(r.report_id, r.modeling_text, len(r.narratives)) for r in made] == [("1", "first narrative\n\nsecond", 2)]
    assert documents.corpus_counts(rows).first() == (2, 1, 2, 1)
    with pytest.raises(LookupError):
        documents.lookup(rows, "9")
    with pytest.raises(ValueError):
        documents.research_corpus({"a": rows, "b": rows})


def test_cleaning_and_folding(spark):
    rows = spark.createDataFrame([("Café\tNO leakage; 5 mm\r\nModel X-200.\x00", "Straße  ΣΑΣ")], "a string, b string")
    got = rows.select(S.clean("a"), S.folded("b")).first()
    assert tuple(got) == ("Café NO leakage; 5 mm Model X-200.", "strasse σασ")


def similar(spark, texts):
    return spark.createDataFrame([(i, r, t, d) for i, (r, t, d) in enumerate(texts)], "narrative_id long, report_id string, text string, received date")


def test_near_pairs_equal_brute_force(spark):
    import random

    rng, texts = random.Random(6), []
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.randint(30, 60))] for _ in range(6)]
    days = [dt.date(2024, 5, 1), dt.date(2025, 5, 1), dt.date(2026, 5, 1), None]
    for i in range(70):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = "edit"
        texts.append((str(i // 2), " ".join(words[: rng.choice([2, 99, 99])]), rng.choice(days)))
    rows = duplicates.narratives(similar(spark, texts), "narrative_id", "report_id", "text", "received")

    def grams(t):
        w = t.split()
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}

    rank, want = {days[0]: 0, days[1]: 1, days[2]: 2}, set()
    for i, (r, t, d) in enumerate(texts):
        for j, (r2, t2, d2) in enumerate(texts):
            if d and d2 and rank[d2] < rank[d] and r != r2 and t != t2:
                a, b = grams(t), grams(t2)
                if a and b and 9 * len(a & b) >= 4 * (len(a) + len(b)):
                    want.add((i, j))
    assert {(r.target, r.prior) for r in duplicates.near_pairs(rows).collect()} == want and want


def test_no_cap_on_partners(spark):
    words = [f"w{i}" for i in range(120)]
    texts = [(str(i), " ".join(words[:-1] + [f"x{i}"]), dt.date(2024, 1, 1)) for i in range(251)] + [("t", " ".join(words), dt.date(2025, 5, 1))]
    rows = duplicates.narratives(similar(spark, texts), "narrative_id", "report_id", "text", "received")
    assert duplicates.near_pairs(rows).count() == 251


def test_exact_groups_and_key_overlaps(spark):
    texts = [("1", "Same  text", dt.date(2024, 1, 1)), ("2", "same text", dt.date(2025, 1, 1)), ("3", "SAME TEXT", None), ("4", "other", dt.date(2024, 1, 1)), ("4", "else", dt.date(2026, 1, 1)), ("4", "none", None)]
    rows = duplicates.narratives(similar(spark, texts), "narrative_id", "report_id", "text", "received")
    group = duplicates.exact_groups(rows).first()
    assert (group.narratives, group.reports, group.n_undated, group.crosses_splits) == (3, 3, 1, True)
    assert duplicates.exact_members(rows).count() == 3
    over = duplicates.key_overlaps(rows).first()
    assert (over.report_id, over.narratives, over.n_undated) == ("4", 3, 1)


def test_tfidf_has_no_leak(spark):
    docs = spark.createDataFrame([("1", "pump failed pump", "train"), ("2", "pump failed", "train"), ("3", "novel pump", "test"), ("4", "pump", None)], "report_id string, modeling_text string, split string")
    made = tfidf.baseline(docs, 10)
    terms = {r.term for r in made["word_vocabulary"].collect()}
    assert terms == set() or "novel" not in terms
    more = spark.createDataFrame([("5", "stent", "train"), ("6", "lead wire", "train")], docs.schema).union(docs)
    made = tfidf.baseline(more, 10)
    assert {r.term for r in made["word_vocabulary"].collect()} == {"pump", "failed", "pump failed"}
    norms = made["word_weights"].groupBy("report_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert {r.report_id for r in norms} == {"1", "2", "3"} and all(r.n == pytest.approx(1) for r in norms)
    grams = spark.createDataFrame([("ab cde",)], "t string").select(tfidf.char_terms(F.col("t"))).first()[0]
    assert sorted(grams) == sorted([" ab", "ab ", " ab ", " cd", "cde", "de ", " cde", "cde ", " cde "])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "", " ", "x y", "1"]), max_size=4), min_size=1, max_size=20))
def test_rows_are_conserved(spark, rows):
    frame = spark.createDataFrame([(i + 2, r, "|".join(r)) for i, r in enumerate(rows)], "line long, fields array<string>, raw string")
    judged = pipe.classified(frame, ["MDR_TEXT_KEY", "B"], ("mdr_text_key",))
    counts = pipe.parse_counts(judged).first()
    good = sum(len(r) == 2 and bool(r[0].strip()) for r in rows)
    assert (counts.seen, counts.accepted, counts.rejected) == (len(rows), good, len(rows) - good)


def test_a_month_without_any_report_is_missing(spark):
    days = [dt.date(2024, 1 + m, 5) for m in range(12) if m != 6] + [dt.date(2025, 1 + m, 5) for m in range(6)]
    reports = spark.createDataFrame([(str(i), "I", d, "s") for i, d in enumerate(days)], "mdr_report_key string, event_type string, date_received date, dataset_snapshot_id string")
    devices = spark.createDataFrame([(str(i), "ABC") for i in range(len(days))], "mdr_report_key string, device_report_product_code string")
    indicators = signals.report_indicators(reports, devices)
    bounds = signals.window_bounds(indicators, dt.date(2025, 7, 1))
    assert [r.month for r in signals.missing_months(signals.monthly_cohorts(indicators), bounds).collect()] == [dt.date(2024, 7, 1)]
