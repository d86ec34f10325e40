"""The whole pipeline over synthetic drops against a day-by-day reading of the rules."""

import datetime as dt
import shutil
from collections import Counter, defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lodestrata.operators.quality import QualityError, snapshot_hash
from lodestrata.plans import config, reports
from lodestrata.plans.refresh import Store, import_gold, refresh
from lodestrata.plans.silver import lease_candidates
from lodestrata.sources.versions import current_release
from tests.drops import FIRST, LAST, expected_days, make_drops, month_bounds, seen_stays

ALL_DAYS = [FIRST + dt.timedelta(days=i) for i in range(181)]
VOLATILE = ("_ingested_at_utc", "_quarantined_at_utc")


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("refresh")
    (base / "source").mkdir()
    known = make_drops(base / "source")
    expected = config.Expectations(
        files={d.name: 6 for d in config.DOMAINS} | {config.ALL_DROPS: 48, config.DICTIONARY: 0},
        silver={"yardi_leases": 60, "hubspot_leads": 72},
        quarantine={"resident_conflicts": known["conflicts"], "invalid_unit_communities": 6, "conflicting_leads": 3},
        gold={"dim_date": 181, "fact_occupancy_monthly": 84, "fact_resident_day": len(expected_days(known))},
        findings={"lease versions removed": 30, "completed move-outs": 30, "invalid hourly rates": 0},
    )
    result = refresh(spark, str(base / "source"), str(base / "store"), str(base / "export"), expected)
    return base, known, expected, result


def test_bronze_is_text_with_lineage(run):
    bronze = run[3].bronze["pcc_residents"]
    assert dict(bronze.drop("_row_number", "_ingested_at_utc").dtypes).values() and set(
        dict(bronze.drop("_row_number", "_ingested_at_utc").dtypes).values()
    ) == {"string"}
    assert bronze.where("_source_month = '2025_01' and mobility_status is not null").count() == 0
    assert bronze.where("_source_month = '2025_02' and mobility_status is null").count() == 0


def test_impostor_is_quarantined(run):
    held = run[3].quarantine["resident_conflicts"].collect()
    assert [(r.first_name, r.candidate_rank, r.candidate_count, r._source_month) for r in held] == [("Bob", 2, 2, "2025_03")]
    assert run[3].silver["pcc_residents"].where("first_name = 'Bob'").count() == 0


def test_acuity_flags(run):
    people = run[3].silver["pcc_residents"]
    seen = {r.acuity_score_raw: (r.acuity_score, r.invalid_acuity_flag) for r in people.collect()}
    assert seen["5"] == (5, False)
    assert all(seen.get(raw, want) == want for raw, want in {"0": (None, True), "high": (None, False), None: (None, False), "7.5": (8, False)}.items())


def test_resident_days(run):
    _, known, _, result = run
    got = {(r.resident_id, r.date): (r.community_id, r.care_level) for r in result.gold["fact_resident_day"].collect()}
    assert got == expected_days(known)


def test_incidents(run):
    _, known, _, result = run
    days, stays = expected_days(known), seen_stays(known)
    outside = set()
    for incident, who, _, when in known["incidents"]:
        stay = stays.get(who)
        if stay is None or when < stay[1] or (stay[2] and when > stay[2]):
            outside.add(incident)
    assert {r.incident_id for r in result.quarantine["incidents_outside_residency"].collect()} == outside
    got = {r.incident_id: (r.community_id, r.care_level) for r in result.gold["fact_incident"].collect()}
    assert got == {i: (c, days[(who, when)][1]) for i, who, c, when in known["incidents"] if i not in outside}


def test_occupancy_report(run):
    _, known, _, result = run
    days = expected_days(known)
    rows = reports.monthly_occupancy(result.model).collect()
    assert len(rows) == 84 and [tuple(r[c] for c in ("month_start", "community_id")) for r in rows] == sorted((r.month_start, r.community_id) for r in rows)
    for r in rows:
        occupied = sum(1 for (_, d), (c, _) in days.items() if d == r.month_end and c == r.community_id)
        assert (r.occupied_resident_count, r.valid_unit_count) == (occupied, 5)
        assert r.occupancy_proxy_percent == round(100 * occupied / 5, 2)


def test_move_out_reasons(run):
    _, known, _, result = run
    counts = defaultdict(Counter)
    for _, community, _, reason in known["leases"]:
        counts[community][reason] += 1
    want = []
    for community, reasons in counts.items():
        ordered = sorted(reasons.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
        total = sum(reasons.values())
        want += [(community, i + 1, reason, n, total, round(100 * n / total, 2)) for i, (reason, n) in enumerate(ordered)]
    columns = "community_id reason_rank move_out_reason move_out_count community_move_out_count community_move_out_percent".split()
    got = [tuple(r[c] for c in columns) for r in reports.top_move_out_reasons(result.model).collect()]
    assert got == sorted(want)


def test_incident_rate_report(run):
    _, known, _, result = run
    days = expected_days(known)
    exposure = Counter(days.values())
    incidents = Counter((r.community_id, r.care_level) for r in result.gold["fact_incident"].collect())
    rows = reports.incident_rate(result.model).collect()
    got = {(r.community_id, r.care_level): (r.incident_count, r.resident_days, r.incidents_per_100_resident_days) for r in rows}
    assert got == {g: (incidents.get(g, 0), n, round(100 * incidents.get(g, 0) / n, 4)) for g, n in exposure.items()}


def window_measures(known, result, keep=lambda community: True, selected=lambda day: True):
    """The five measures, counted one by one; `selected` is a choice of dates. Nothing to count is a blank."""
    end = max(d for d in ALL_DAYS if selected(d))
    days = {k: v for k, v in expected_days(known).items() if keep(v[0])}
    incidents = [(r.incident_date, r.community_id) for r in result.gold["fact_incident"].collect() if keep(r.community_id)]
    window = [d for d in ALL_DAYS if 0 <= (end - d).days < 90]
    recent = [d for (_, d) in days if d in window]
    leases = [when for _, community, when, _ in known["leases"] if keep(community)]
    members = [c for c in (f"C{n:03d}" for n in range(1, 15)) if keep(c)]
    last_month = max(d for d in ALL_DAYS if selected(d) and d.day == 1)
    month_end = month_bounds(f"{last_month.year}_{last_month.month:02d}")[1]
    chosen = [d for (_, d) in days if selected(d)]
    gone, hurt = sum(1 for when in leases if when in window), sum(1 for d, _ in incidents if d in window)
    hurt_then = sum(1 for d, _ in incidents if selected(d))
    return {
        "current_occupancy": sum(1 for (_, d) in days if d == month_end) / (5 * len(members)),
        "move_out_rate": gone / (len(recent) / len(window)) if gone else None,
        "incident_rate": 100 * hurt_then / len(chosen) if hurt_then else None,
        "rolling_incident_rate": 100 * hurt / len(recent) if hurt else None,
        "completed_move_outs": sum(1 for when in leases if selected(when)) or None,
    }


def test_a_selection_of_dates_moves_the_windows_but_does_not_cut_them(run):
    _, known, _, result = run
    march = result.model.filtered({"dim_date": F.col("month_number") == 3})
    want = window_measures(known, result, selected=lambda d: d.month == 3)
    assert reports.kpi_cards(march).first().asDict() == pytest.approx(want)
    for series, measure in ((reports.move_out_rate_by_day, "move_out_rate"), (reports.incident_rate_by_day, "rolling_incident_rate")):
        rows = {r.date: r.rate for r in series(march).collect()}
        assert len(rows) == 31 and rows[max(rows)] == pytest.approx(want[measure])
    south = reports.slicer(march, region="South")
    want = window_measures(known, result, lambda c: c >= "C010", lambda d: d.month == 3)
    assert reports.kpi_cards(south).first().asDict() == pytest.approx(want)


def test_kpi_cards(run):
    _, known, _, result = run
    assert reports.kpi_cards(result.model).first().asDict() == pytest.approx(window_measures(known, result))


@pytest.mark.parametrize(
    ("role", "keep"),
    [("Regional Director", lambda c: c in {"C001", "C002", "C003", "C004", "C005"}), ("Community Executive Director", lambda c: c == "C001")],
)
def test_roles_reach_every_fact(run, role, keep):
    _, known, _, result = run
    seen = reports.for_role(result.model, role)
    assert reports.kpi_cards(seen).first().asDict() == pytest.approx(window_measures(known, result, keep))


def test_slicers_and_matrix(run):
    _, known, _, result = run
    one = reports.slicer(result.model, region="Southwest", community="Community C007")
    assert reports.measures(one, ("current_occupancy",)).first()[0] == pytest.approx(window_measures(known, result, lambda c: c == "C007")["current_occupancy"])
    matrix = {r.community_name: r for r in reports.community_matrix(result.model).collect()}
    assert len(matrix) == 15
    for name, keep in (("Total", lambda c: True), ("Community C003", lambda c: c == "C003")):
        want = window_measures(known, result, keep)
        for measure in ("current_occupancy", "move_out_rate", "incident_rate"):
            assert matrix[name][measure] == pytest.approx(want[measure])


def test_dashboard_tables(run):
    _, known, _, result = run
    model = result.model
    assert reports.community_list(model).count() == 14
    assert reports.occupancy_by_month(model).count() == 6
    shares = [r.current_occupancy for r in reports.occupancy_by_community(model).collect()]
    assert shares == sorted(shares, reverse=True) and len(shares) == 14
    assert [r.display_order for r in reports.incident_rate_by_care_level(model).collect()] == [1, 2, 3]
    reasons = Counter(reason for *_, reason in known["leases"])
    worst = sorted(reasons.values(), reverse=True)[:5][-1]
    assert {r.move_out_reason: r.completed_move_outs for r in reports.leading_move_out_reasons(model).collect()} == {k: n for k, n in reasons.items() if n >= worst}


def test_measures_as_they_stood_each_day(run):
    _, known, _, result = run
    want = window_measures(known, result)
    for series, measure in ((reports.move_out_rate_by_day, "move_out_rate"), (reports.incident_rate_by_day, "rolling_incident_rate")):
        rows = {r.date: r.rate for r in series(result.model).collect()}
        assert len(rows) == 181 and rows[LAST] == pytest.approx(want[measure])


def test_trailing_rates_by_month(run):
    _, known, _, result = run
    months = {r.month_start.month: r for r in reports.trailing_rates_by_month(result.model, ("dim_community.region",)).collect() if r.region == "South"}
    want = window_measures(known, result, lambda c: c >= "C010")
    assert len(months) == 6
    for measure in ("move_out_rate", "rolling_incident_rate"):
        assert months[6][measure] == pytest.approx(want[measure])
    with pytest.raises(ValueError, match="trailing_series"):
        reports.measures(result.model, by=("dim_date.month_start",))


def test_published_tables_hide_identifiers(run):
    for name, df in reports.published_tables(run[3].model).items():
        assert not {"resident_id", "lease_id", "unit_id", "incident_id"} & set(df.columns), name


def test_constraints_and_summary(run):
    result = run[3]
    assert result.constraints().where("issues <> 0").count() == 0
    counts = {r.name: r.actual for r in result.summary().collect()}
    assert counts["bronze.yardi_leases"] == 90 and counts["gold.dim_community"] == 14
    assert {r.category: r.row_count for r in result.rejections.collect()}["conflicting_leads"] == 3


def test_export_reads_back(run, spark):
    base, _, _, result = run
    model = import_gold(spark, str(base / "export"))
    for name, df in result.gold.items():
        assert model[name].count() == df.count()
    assert dict(model["fact_incident"].dtypes)["severity"] == "bigint"
    assert reports.kpi_cards(model).first().asDict() == pytest.approx(reports.kpi_cards(result.model).first().asDict())


def test_second_run_gives_the_same_tables(run, spark, tmp_path):
    base, _, expected, result = run
    layers = ("bronze", "silver", "quarantine", "gold")

    def prints(done):
        return {(layer, n): tuple(snapshot_hash(df, VOLATILE).first()) for layer in layers for n, df in getattr(done, layer).items()}

    before = prints(result)
    for _ in range(2):
        again = refresh(spark, str(base / "source"), str(tmp_path / "store"), str(tmp_path / "export"), expected)
        assert prints(again) == before


def test_gates_stop_the_run(run, spark, tmp_path):
    base, _, expected, _ = run
    with pytest.raises(QualityError, match="pcc_residents: expected 7, found 6"):
        refresh(spark, str(base / "source"), str(tmp_path), None, replace(expected, files={"pcc_residents": 7}))
    with pytest.raises(QualityError, match="data dictionary: expected 1, found 0"):
        refresh(spark, str(base / "source"), str(tmp_path))
    with pytest.raises(QualityError, match="fact_lease: expected 1, found 60"):
        refresh(spark, str(base / "source"), str(tmp_path), str(tmp_path / "export"), replace(expected, gold={"fact_lease": 1}))
    assert not (tmp_path / "export").exists()


def test_lease_candidates_keep_every_version(run):
    candidates = lease_candidates(run[3].bronze["yardi_leases"])
    assert candidates.count() == 90
    assert candidates.where("lease_rank = 1").drop("lease_rank", "lease_version_count").exceptAll(run[3].silver["yardi_leases"]).count() == 0
    assert candidates.where(F.col("lease_version_count") > 1).count() == 60


def test_catalog_tables(spark, run, tmp_path):
    base, *_ = run
    refresh(spark, str(base / "source"), str(tmp_path), None, config.Expectations(), catalog=True)
    assert spark.sql("select count(*) from gold.fact_lease l join gold.dim_community using (community_id)").first()[0] == 60
    assert str(spark.sql("select silver.parse_date('3/7/2025')").first()[0]) == "2025-03-07"
    assert spark.table("quarantine.rejection_summary").count() == 4
    assert spark.table("silver._lease_candidates").count() >= spark.table("silver.yardi_leases").count()
    named = ("monthly_occupancy", "top_move_out_reasons", "incident_rate")
    assert all(spark.table(f"reports.{name}").count() > 0 for name in named)
    for layer in ("bronze", "silver", "quarantine", "gold", "reports"):
        spark.sql(f"drop database {layer} cascade")


def test_a_failed_run_changes_nothing(spark, run, tmp_path):
    """Readers of the store and of the export keep the tables of the run before, and gates need no job."""
    base, _, expected, result = run
    store, export = str(tmp_path / "store"), str(tmp_path / "export")
    refresh(spark, str(base / "source"), store, export, expected)
    before = current_release(spark, store), current_release(spark, export)
    with pytest.raises(QualityError, match="completed move-outs: expected 31, found 30"):
        refresh(spark, str(base / "source"), store, export, replace(expected, findings={"completed move-outs": 31}))
    assert (current_release(spark, store), current_release(spark, export)) == before
    assert Store(spark, store).read("gold", "fact_resident_day").count() == result.gold["fact_resident_day"].count()
    assert import_gold(spark, export)["fact_lease"].count() == 60
    with pytest.raises(FileNotFoundError):
        Store(spark, store).read("gold", "fact_of_none")


def test_counts_are_taken_while_writing(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    tracker = spark.sparkContext.statusTracker()
    rows = spark.range(0, 100, 1, 7).withColumn("part", F.col("id") % 3)
    store.write("a", "full", rows, ("part",), {"odd": F.count_if(F.col("id") % 2 == 1), "most": F.max("id")})
    store.write("a", "empty", rows.where("id < 0"), (), {"odd": F.count_if(F.col("id") % 2 == 1)})
    jobs = len(tracker.getJobIdsForGroup(None))
    assert store.rows("a") == {"full": 100, "empty": 0}
    assert store.written["a", "full"].counts == {"odd": 50, "most": 99} and store.written["a", "empty"].counts == {"odd": 0}
    assert len(tracker.getJobIdsForGroup(None)) == jobs
    assert store.read("a", "full").columns == ["id", "part"]


def test_malformed_lines_are_quarantined(spark, run, tmp_path):
    base, _, expected, result = run
    assert result.quarantine["malformed_rows"].count() == 0
    source = tmp_path / "source"
    shutil.copytree(base / "source", source)
    broken = sorted(source.glob("gbp_reviews_*.csv"))[0]
    broken.write_text(broken.read_text().rstrip("\n") + "\nr1,C001,2025-01-05,5,good,,,one,too many\n")
    found = refresh(spark, str(source), str(tmp_path / "store"), None, config.Expectations())
    held = found.quarantine["malformed_rows"].collect()
    assert [(r._line, r._source_table, r._delivered_fields - r._header_fields) for r in held] == [("r1,C001,2025-01-05,5,good,,,one,too many", "gbp_reviews", 2)]
    assert found.bronze["gbp_reviews"].where("review_id = 'r1'").count() == 0
    with pytest.raises(QualityError, match="malformed_rows: expected 0, found 1"):
        refresh(spark, str(source), str(tmp_path / "store"), None, config.Expectations(quarantine={"malformed_rows": 0}))


def test_blank_measures(run):
    """Where nothing happened the measures have no value; the reports say 0."""
    model = run[3].model
    quiet = reports.slicer(model, community="Community of none")
    assert set(reports.kpi_cards(quiet).first().asDict().values()) == {None}
    calm = replace(model, tables={**model.tables, "fact_incident": model.tables["fact_incident"].where("false")})
    assert set(reports.measures(calm, ("incident_rate", "rolling_incident_rate")).first().asDict().values()) == {None}
    assert {r.incidents_per_100_resident_days for r in reports.incident_rate(calm).collect()} == {0.0}
