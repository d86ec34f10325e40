"""Synthetic monthly drops with one case per cleansing rule, and what a plain reading of the rules makes of them."""

from __future__ import annotations

import calendar
import csv
import datetime as dt
import random
from pathlib import Path

MONTHS = [f"2025_{m:02d}" for m in range(1, 7)]
LEVELS = ["IL", "independent", "Assisted Living", "AL", " memory ", "MC"]
CANON = {"il": "Independent Living", "independent": "Independent Living", "assisted living": "Assisted Living",
         "al": "Assisted Living", "memory": "Memory Care", "mc": "Memory Care"}
COMMUNITIES = [f"C{n:03d}" for n in range(1, 15)]


def write(root: Path, domain: str, month: str, rows: list[dict], columns: list[str]) -> None:
    with open(root / f"{domain}_{month}.csv", "w", newline="") as f:
        out = csv.DictWriter(f, columns, lineterminator="\n")
        out.writeheader()
        out.writerows(rows)


def month_bounds(month: str) -> tuple[dt.date, dt.date]:
    year, number = map(int, month.split("_"))
    return dt.date(year, number, 1), dt.date(year, number, calendar.monthrange(year, number)[1])


def us(day: dt.date) -> str:
    return f"{day.month}/{day.day:02d}/{day.year}"


def make_drops(root: Path, people: int = 60, seed: int = 7) -> dict:
    """Writes all eight domains for six months and returns the facts a test needs to know about them."""
    rng = random.Random(seed)
    residents = []
    for n in range(people):
        admit = dt.date(2024, 11, 1) + dt.timedelta(days=rng.randrange(200))
        leave = admit + dt.timedelta(days=rng.randrange(0, 150)) if rng.random() < 0.4 else None
        residents.append(
            {
                "resident_id": f"R{n:05d}",
                "community_id": COMMUNITIES[n % 14],
                "first_name": f"Ann{n}",
                "last_name": "Lee",
                "dob": "1940-02-03",
                "gender": "F",
                "admit": admit,
                "leave": leave,
                "level": rng.choice(LEVELS),
            }
        )

    known = {"residents": residents, "changes": [], "snapshots": {}, "incidents": [], "leases": [], "conflicts": 0}
    columns = "resident_id community_id first_name last_name dob gender admit_date discharge_date care_level acuity_score".split()
    for i, month in enumerate(MONTHS):
        first, last = month_bounds(month)
        rows = []
        for n, r in enumerate(residents):
            if r["admit"] > last or (r["leave"] and r["leave"] < first):
                continue
            left = r["leave"] if r["leave"] and r["leave"] <= last else None
            level = rng.choice(LEVELS) if n % 5 == 0 else r["level"]
            rows.append(
                {
                    "resident_id": f" {r['resident_id']}",
                    "community_id": r["community_id"],
                    "first_name": r["first_name"].upper() if i % 2 else r["first_name"],
                    "last_name": r["last_name"],
                    "dob": r["dob"] if i % 2 else "02/03/1940",
                    "gender": r["gender"],
                    "admit_date": us(r["admit"]) if i % 2 else r["admit"].isoformat(),
                    "discharge_date": left.isoformat() if left else "",
                    "care_level": level,
                    "acuity_score": {0: "0", 1: "high", 2: "", 3: "7.5"}.get(n, "5"),
                    "mobility_status": "walker",
                }
            )
            known["snapshots"][(r["resident_id"], month)] = CANON[level.strip().lower()]
        if month == "2025_03":  # an impostor ahead of the real row: less supported, so it must lose
            impostor = dict(rows[0], first_name="Bob")
            rows.insert(0, impostor)
            known["conflicts"] += 1
        # mobility_status arrives in month two, at the front
        write(root, "pcc_residents", month, [{k: v for k, v in row.items() if i or k != "mobility_status"} for row in rows],
              (["mobility_status"] if i else []) + columns)

    for i, month in enumerate(MONTHS):
        first, last = month_bounds(month)
        days = (last - first).days + 1

        changes = []
        for r in residents:
            if rng.random() < 0.25:
                when = first + dt.timedelta(days=rng.randrange(days))
                level = rng.choice([*LEVELS, "unknown level"])
                changes.append({"resident_id": r["resident_id"], "change_date": when.isoformat(), "previous_level": "", "new_level": level, "reason": ""})
                known["changes"].append((r["resident_id"], when, CANON.get(level.strip().lower())))
        write(root, "pcc_care_history", month, changes, "resident_id change_date previous_level new_level reason".split())

        incidents = []
        for n in range(20):
            r = rng.choice(residents)
            who = r["resident_id"] if n else "R99999"
            when = first + dt.timedelta(days=rng.randrange(days))
            incident = {"incident_id": f"I{i}{n:03d}", "resident_id": who, "community_id": r["community_id"], "incident_date": when.isoformat(),
                        "incident_type": "Fall", "severity": str(1 + n % 5), "reported_by": "E1"}
            incidents.append(incident)
            known["incidents"].append((incident["incident_id"], who, r["community_id"], when))
        write(root, "pcc_incidents", month, incidents, "incident_id resident_id community_id incident_date incident_type severity reported_by".split())

        units = [{"unit_id": f"U{n:04d}", "community_id": COMMUNITIES[n % 14], "unit_type": "AL", "monthly_rent": "4000.50", "snapshot_date": first.isoformat()}
                 for n in range(70)]
        units += [{"unit_id": "U9999", "community_id": "C936", "unit_type": "AL", "monthly_rent": "1", "snapshot_date": first.isoformat()}]
        write(root, "yardi_units", month, units, "unit_id community_id unit_type monthly_rent snapshot_date".split())

        leases = []
        for n in range(i * 10, i * 10 + 10):
            leases.append({"lease_id": f"L{n:04d}", "resident_id": f"R{n:05d}", "unit_id": f"U{n:04d}", "community_id": COMMUNITIES[n % 4],
                           "move_in_date": first.isoformat(), "move_out_date": "", "move_out_reason": "", "monthly_rate": "6103"})
        for n in range((i - 1) * 10, (i - 1) * 10 + 6):  # last month's leases that end now
            if n >= 0:
                reason = ["Financial", "Family Decision", "Higher Care Needed", "", "Moved"][n % 5]
                when = first + dt.timedelta(days=n % days)
                leases.append({"lease_id": f"L{n:04d}", "resident_id": f"R{n:05d}", "unit_id": f"U{n:04d}", "community_id": COMMUNITIES[n % 4],
                               "move_in_date": "2025-01-01", "move_out_date": when.isoformat(), "move_out_reason": reason, "monthly_rate": "6103"})
                known["leases"].append((f"L{n:04d}", COMMUNITIES[n % 4], when, reason or "Unknown"))
        write(root, "yardi_leases", month, leases, "lease_id resident_id unit_id community_id move_in_date move_out_date move_out_reason monthly_rate".split())

        roles = ["CNA", "Med Tech", "RN"]
        shifts = [{"shift_id": f"S{i}{n:04d}", "community_id": COMMUNITIES[n % 14], "employee_id": f"E{n}", "role": roles[n % 3], "shift_date": us(first),
                   "hours_worked": "8", "hourly_rate": "{'CNA': 21.75, 'Med Tech': 28, 'RN': 47.10}"} for n in range(30)]
        write(root, "adp_shifts", month, shifts, "shift_id community_id employee_id role shift_date hours_worked hourly_rate".split())

        reviews = [{"review_id": f"G{i}{n}", "community_id": "C001", "review_date": first.isoformat(), "rating": str(1 + n % 5),
                    "review_text": 'Nice, "really" nice', "response_text": "", "responded_at": last.isoformat() if n % 2 else ""} for n in range(7)]
        write(root, "gbp_reviews", month, reviews, "review_id community_id review_date rating review_text response_text responded_at".split())

        leads = [{"lead_id": f"H{i}{n:02d}", "community_id": "C002", "lead_source": "Web", "created_date": first.isoformat(), "tour_date": "2025-02-10",
                  "deposit_date": "2025-02-09" if n == 1 else "", "move_in_date": "", "status": "Open", "lost_reason": ""} for n in range(12)]
        if i in (2, 3, 5):  # one id three times, twice with the same content
            leads.append({"lead_id": "HX", "community_id": "C002" if i < 5 else "C003", "lead_source": "Web", "created_date": "2025-01-01", "tour_date": "",
                          "deposit_date": "", "move_in_date": "", "status": "Won", "lost_reason": ""})
        write(root, "hubspot_leads", month, leads, "lead_id community_id lead_source created_date tour_date deposit_date move_in_date status lost_reason".split())
    return known


FIRST, LAST = dt.date(2025, 1, 1), dt.date(2025, 6, 30)


def seen_stays(known: dict) -> dict[str, tuple[str, dt.date, dt.date | None]]:
    """Stay per resident as the snapshots show it: a departure counts once a snapshot carries it."""
    stays = {}
    for r in known["residents"]:
        months = [m for m in MONTHS if (r["resident_id"], m) in known["snapshots"]]
        if not months:
            continue
        reported = any(r["leave"] and month_bounds(m)[0] <= r["leave"] <= month_bounds(m)[1] for m in months)
        stays[r["resident_id"]] = (r["community_id"], r["admit"], r["leave"] if reported else None)
    return stays


def expected_days(known: dict) -> dict[tuple[str, dt.date], tuple[str, str | None]]:
    """(resident, day) -> (community, level), one resident and day at a time."""
    days = {}
    for who, (community, admit, leave) in seen_stays(known).items():
        history = sorted((when, level) for r, when, level in known["changes"] if r == who and level)
        day = max(admit, FIRST)
        while day <= min(leave or LAST, LAST):
            past = [level for when, level in history if when <= day]
            shot = known["snapshots"].get((who, f"{day.year}_{day.month:02d}"))
            days[(who, day)] = (community, past[-1] if past else shot)
            day += dt.timedelta(days=1)
    return days
