"""Batch audit of claims, visits and records against the rules.

The rule texts describe checks that no code in the source pipeline runs; this
module runs them as Spark jobs. Every check returns findings with one schema:

  rule_id, record_key STRING, finding_date STRING (ISO day or null),
  severity ('block' | 'warn' | 'report'), detail STRING

Scale notes:
- Window rules (A1, A2, A6) first pre-aggregate to one row per (patient, day)
  with partial aggregation, so a patient holding a third of all lines becomes
  one row per day before the range window; A1 and A2 share that partitioning
  and are computed in one select.
- The same-day pair rule (A11) never pairs lines inside a group: each line
  meets the pair-role table on its code, and a partial-aggregating group-by
  on (patient, day, pair) keeps pairs whose two roles both occurred. One scan
  of the claims, one shuffle; work is bounded by lines x pair fan-out, not by
  lines squared.
- Dimension tables with a fixed size (code lists, cap schedule, TPC-H nation
  and region) are broadcast; data-sized sides are left to AQE, which
  broadcasts only after measuring them.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regloom.operators.ptp import RELEVANT_CODES

FINDING_COLUMNS = ["rule_id", "record_key", "finding_date", "severity", "detail"]

# Severity by rule maturity (evolving warns, established blocks).
MATURITY = {
    "R-FL-05": "evolving",
    "R-FED-03": "established",
    "R-FED-04": "established",
    "R-FED-05": "established",
    "R-FED-06": "established",
    "R-FASAMS-01": "evolving",
    "R-FASAMS-02": "evolving",
    "R-MSO-01": "contract",
    "R-PDMP-01": "established",
    "R-CRED-01": "established",
    "R-TPLAN-01": "established",
}
BUNDLE_CODES = [f"G20{n}" for n in range(67, 80)]  # G2067..G2079
SUD_CODES = [c for c in RELEVANT_CODES if c.startswith("H")]
CAP_SCHEDULE = [(0, 14, 7), (15, 31, 14), (32, None, 28)]  # days in treatment -> cap days
#: Last day that rows of a dated schedule are binned for.
CAP_HORIZON = "2099-12-31"


def severity(rule_id: str) -> str:
    m = MATURITY.get(rule_id)
    return {"evolving": "warn", "established": "block"}.get(m, "report")


def _day(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def finding(df: DataFrame, rule_id: str, key: Column, day: Column | None, detail: Column) -> DataFrame:
    return df.select(
        F.lit(rule_id).alias("rule_id"),
        key.cast("string").alias("record_key"),
        (_day(day) if day is not None else F.lit(None).cast("string")).alias("finding_date"),
        F.lit(severity(rule_id)).alias("severity"),
        detail.cast("string").alias("detail"),
    )


def findings_one_pass(df: DataFrame, specs: list[tuple[str, Column, Column, Column | None, Column]]) -> DataFrame:
    """Several checks over the same rows in ONE pass: each spec is (rule_id,
    condition, key, day, detail); a row yields one finding per true condition.
    A union of per-check filters would recompute the input once per check."""
    items = [
        F.when(
            F.coalesce(cond, F.lit(False)),
            F.struct(
                F.lit(rule_id).alias("rule_id"),
                key.cast("string").alias("record_key"),
                (_day(day) if day is not None else F.lit(None).cast("string")).alias("finding_date"),
                F.lit(severity(rule_id)).alias("severity"),
                detail.cast("string").alias("detail"),
            ),
        )
        for rule_id, cond, key, day, detail in specs
    ]
    hits = F.filter(F.array(*items), lambda x: x.isNotNull())
    return df.select(F.explode(hits).alias("_f")).select(*[F.col(f"_f.{c}").alias(c) for c in FINDING_COLUMNS])


def _claim_key() -> Column:
    return F.concat_ws(":", F.col("claim_id").cast("string"), F.col("line_no").cast("string"))


def _mods(c: str = "modifiers_csv") -> Column:
    return F.filter(F.split(F.coalesce(F.col(c), F.lit("")), ","), lambda m: m != "")


# ------------------------------------------------------------ window rules
def daily_services(claims: DataFrame) -> DataFrame:
    """One row per (patient, day): bundle lines, G0137 lines, and line counts
    that qualify for each rule (partial aggregation before the shuffle)."""
    code = F.col("code")
    return claims.groupBy("patient_id", "service_date").agg(
        F.count_if(code.isin(BUNDLE_CODES)).alias("bundle_lines"),
        F.count_if(~code.isin(BUNDLE_CODES)).alias("non_bundle_lines"),
        F.count_if(code == "G0137").alias("iop_lines"),
        F.count_if(code != "G0137").alias("non_iop_lines"),
    )


def bundle_and_iop(claims: DataFrame, min_services: int = 1, iop_required: int = 9, window_days: int = 7) -> DataFrame:
    """A1 (R-FED-01) and A2 (R-FED-02): trailing ``window_days`` inclusive."""
    d = daily_services(claims)
    w = Window.partitionBy("patient_id").orderBy(F.unix_date("service_date")).rangeBetween(-(window_days - 1), 0)
    win = d.select(
        "*",
        F.sum("non_bundle_lines").over(w).alias("bundle_window_services"),
        F.sum("non_iop_lines").over(w).alias("iop_window_services"),
    )
    p, d = F.col("patient_id"), F.col("service_date")
    bw, iw = F.col("bundle_window_services"), F.col("iop_window_services")
    return findings_one_pass(win, [
        ("R-FED-01", (F.col("bundle_lines") > 0) & (bw < min_services), p, d,
         F.concat(F.lit("services_in_window="), bw.cast("string"))),
        ("R-FED-02", (F.col("iop_lines") > 0) & (iw < iop_required), p, d,
         F.concat(F.lit("services_in_window="), iw.cast("string"))),
    ])


def dosing_counseling_ratio(visits: DataFrame, min_sessions: int = 1, window_days: int = 30) -> DataFrame:
    """A6 (R-FL-05): each dosing day needs >= min counseling sessions in the
    trailing window (inclusive)."""
    k = F.col("kind")
    d = visits.groupBy("patient_id", "service_date").agg(
        F.count_if(k == "DOSING").alias("dosing"), F.count_if(k == "COUNSELING").alias("counseling")
    )
    w = Window.partitionBy("patient_id").orderBy(F.unix_date("service_date")).rangeBetween(-(window_days - 1), 0)
    win = d.select("*", F.sum("counseling").over(w).alias("counseling_in_window"))
    return finding(
        win.filter((F.col("dosing") > 0) & (F.col("counseling_in_window") < min_sessions)),
        "R-FL-05", F.col("patient_id"), F.col("service_date"),
        F.concat(F.lit("counseling_in_window="), F.col("counseling_in_window").cast("string")),
    )


# ------------------------------------------------------------ line rules
def _pos_spec():
    c = F.col("code")
    return ("R-FL-02", (c == "H0020") & ~F.coalesce(F.col("pos") == "58", F.lit(False)), _claim_key(), F.col("service_date"),
            F.concat(F.lit("pos="), F.coalesce(F.col("pos"), F.lit("null"))))


def _hf_spec(sud_codes: Sequence[str] = SUD_CODES):
    return ("R-FL-03", F.col("code").isin(list(sud_codes)) & ~F.array_contains(_mods(), "HF"), _claim_key(), F.col("service_date"),
            F.concat(F.lit("modifiers="), F.coalesce(F.col("modifiers_csv"), F.lit(""))))


def _sequence_spec():
    mods = _mods()
    dx = F.split(F.coalesce(F.col("dx"), F.lit("")), ",")
    pregnant = F.exists(dx, lambda x: x.startswith("O"))
    hd, hg = F.array_position(mods, "HD"), F.array_position(mods, "HG")
    ok = F.when(pregnant, (hd > 0) & (hg > 0) & (hd < hg)).otherwise((hg > 0) & (hd == 0))
    detail = F.concat(F.when(pregnant, F.lit("pregnant ")).otherwise(F.lit("")), F.lit("modifiers="), F.coalesce(F.col("modifiers_csv"), F.lit("")))
    return ("R-FL-04", (F.col("code") == "H0020") & ~ok, _claim_key(), F.col("service_date"), detail)


def _dx_spec(prefix: str = "F11.2"):
    dx = F.split(F.coalesce(F.col("dx"), F.lit("")), ",")
    return ("R-SUNSHINE-01", F.col("code").rlike("^H[0-9]{4}$") & ~F.exists(dx, lambda x: x.startswith(prefix)), _claim_key(),
            F.col("service_date"), F.concat(F.lit("dx="), F.coalesce(F.col("dx"), F.lit(""))))


def point_of_care(claims: DataFrame) -> DataFrame:
    """A3 (R-FL-02): H0020 must be billed at POS 58; a null POS violates."""
    return findings_one_pass(claims, [_pos_spec()])


def substance_modifier(claims: DataFrame, sud_codes: Sequence[str] = SUD_CODES) -> DataFrame:
    """A4 (R-FL-03): SUD codes need the HF modifier."""
    return findings_one_pass(claims, [_hf_spec(sud_codes)])


def modifier_sequence(claims: DataFrame) -> DataFrame:
    """A5 (R-FL-04): H0020 for a pregnant patient (a dx starting with 'O')
    needs HD before HG; otherwise HG alone (no HD)."""
    return findings_one_pass(claims, [_sequence_spec()])


def diagnosis_required(claims: DataFrame, prefix: str = "F11.2") -> DataFrame:
    """A13 (R-SUNSHINE-01): H-code lines need a diagnosis starting with F11.2."""
    return findings_one_pass(claims, [_dx_spec(prefix)])


def claim_line_checks(claims: DataFrame) -> DataFrame:
    """A3, A4, A5 and A13 over the claim lines in one pass."""
    return findings_one_pass(claims, [_pos_spec(), _hf_spec(), _sequence_spec(), _dx_spec()])


def standard_codes(claims: DataFrame) -> DataFrame:
    """A12 (R-FLMAC-01, block_standard_hcpcs): lines without a G-code on an OTP
    claim, which is one that bills a code of G2067 to G2079."""
    otp = claims.filter(F.col("code").isin(BUNDLE_CODES)).select("claim_id").distinct()
    bad = claims.filter(~F.col("code").rlike("^G[0-9]{4}$")).join(otp, "claim_id", "left_semi")
    return finding(bad, "R-FLMAC-01", _claim_key(), F.col("service_date"), F.concat(F.lit("standard code="), F.col("code")))


def payer_blocker(claims: DataFrame, allowed: DataFrame) -> DataFrame:
    """A12 (R-FLMAC-01): G-code lines whose code is not in the allowed list;
    ``standard_codes`` is the rule's other half.

    ``allowed`` (code) comes from the rule's enforce list; an empty list
    reports nothing (the semi join keeps no rows).
    """
    g = claims.filter(F.col("code").rlike("^G[0-9]{4}$"))
    # An anti join on the code; the list's emptiness is one flag, met on the
    # code family letter (the list holds at most 10,000 codes: G and four digits).
    listed = allowed.filter(F.col("code").rlike("^G[0-9]{4}$")).select("code").distinct()
    some = listed.groupBy(F.substring("code", 1, 1).alias("_family")).agg(F.count(F.lit(1)).alias("_n"))
    bad = g.join(listed, "code", "left_anti").join(F.broadcast(some), F.substring("code", 1, 1) == F.col("_family"), "left_semi")
    return finding(bad, "R-FLMAC-01", _claim_key(), F.col("service_date"), F.concat(F.lit("code="), F.col("code")))


def same_day_pairs(claims: DataFrame, pairs: DataFrame) -> DataFrame:
    """A11 (BundleGuard): both codes of a PTP pair (column1, column2) billed
    for one patient on one day. Orientation is kept; modifiers are ignored.

    Lines are reduced first: codes that stand in no pair go, each patient-day
    becomes one row with its set of codes (bounded by the code system, however
    many lines the day has). Each code meets the pair table as first code; the
    second is looked up in the set while joining, so lines are never paired
    with each other. Which side is
    broadcast, and whether a frequent code is split, is left to AQE.
    """
    pair = pairs.select("column1", "column2").distinct()
    known = pair.select(F.explode(F.array("column1", "column2")).alias("code")).distinct()
    days = (
        claims.select("patient_id", "service_date", "code")
        .join(known, "code", "left_semi")
        .groupBy("patient_id", "service_date")
        .agg(F.collect_set("code").alias("_codes"))
    )
    first = days.select("patient_id", "service_date", "_codes", F.explode("_codes").alias("_code"))
    both = (F.col("_code") == F.col("column1")) & F.array_contains("_codes", F.col("column2"))
    hits = first.join(pair, both).select("patient_id", "service_date", "column1", "column2")
    return finding(
        hits, "R-NCCI", F.col("patient_id"), F.col("service_date"),
        F.concat(F.col("column1"), F.lit("+"), F.col("column2")),
    )


# ------------------------------------------------------------ record rules
def vault_reconciliation(vault: DataFrame, allowed_variance: int = 0) -> DataFrame:
    """A10 (R-FED-06): begin + receipts - dispensed - wasted must equal the
    physical count; begin is the previous day's physical count (0 at start).
    Integer units only."""
    w = Window.partitionBy("vault_id").orderBy("day")
    begin = F.coalesce(F.lag("physical_count").over(w), F.lit(0).cast("bigint"))
    v = vault.select("*", begin.alias("begin_count"))
    variance = F.col("physical_count") - (F.col("begin_count") + F.col("received") - F.col("dispensed") - F.col("wasted"))
    bad = v.select("*", variance.alias("variance")).filter(F.abs(F.col("variance")) > allowed_variance)
    return finding(bad, "R-FED-06", F.col("vault_id"), F.col("day"), F.concat(F.lit("variance="), F.col("variance").cast("string")))


def admission_eligibility(admissions: DataFrame, min_months: int = 12) -> DataFrame:
    """A7 (R-FED-03): >= min_months of documented history before admission,
    or a documented exception."""
    months = F.months_between(F.col("admission_date"), F.col("history_start"))
    ok = F.coalesce(months >= min_months, F.lit(False)) | F.coalesce(F.size("exceptions") > 0, F.lit(False))
    bad = admissions.filter(~ok)
    documented = F.coalesce(F.round(months, 2).cast("string"), F.lit("none"))
    return finding(bad, "R-FED-03", F.col("patient_id"), F.col("admission_date"), F.concat(F.lit("months="), documented))


def takehome_stability(requests: DataFrame) -> DataFrame:
    """A8 (R-FED-04): a take-home request without a documented stable home
    (null counts as not documented) is blocked."""
    bad = requests.filter(~F.coalesce(F.col("stable_home"), F.lit(False)))
    return finding(bad, "R-FED-04", F.col("request_id"), F.col("request_date"), F.lit("stable_home not documented"))


def cap_days(days_in_treatment: Column, schedule=CAP_SCHEDULE) -> Column:
    """Cap for a day count from a (lo, hi, cap) schedule (hi None = open end),
    compiled to a CASE: the schedule is a handful of rows, so no range join."""
    out = None
    for lo, hi, cap in schedule:
        cond = days_in_treatment >= lo if hi is None else (days_in_treatment >= lo) & (days_in_treatment <= hi)
        out = F.when(cond, F.lit(cap)) if out is None else out.when(cond, F.lit(cap))
    return out


def scheduled_caps(requests: DataFrame, schedule: DataFrame, horizon: str = CAP_HORIZON) -> DataFrame:
    """Requests with the ``cap_days`` of the schedule row in force on their day.

    ``schedule`` rows (effective_from, effective_to, day_from, day_to,
    cap_days) hold from one date to another (null: until further notice) for a
    range of days in treatment (null: open); they do not overlap. The interval
    join goes by bins: a row is listed under every month it holds in, up to
    the horizon, and a request meets the rows of its month. A request that no
    row covers has a null cap.
    """
    month = lambda c: F.trunc(c, "MM")
    until = F.least(F.coalesce("effective_to", F.to_date(F.lit(horizon))), F.to_date(F.lit(horizon)))
    holds = F.col("effective_from") <= until
    rows = schedule.where(holds).select("*", F.explode(F.sequence(month("effective_from"), month(until), F.expr("interval 1 month"))).alias("_month"))
    dated = requests.withColumn("_month", month("request_date"))
    at, day = F.col("request_date"), F.col("days_in_treatment")
    in_force = (at >= F.col("effective_from")) & (at <= F.coalesce("effective_to", at)) & (day >= F.col("day_from")) & (day <= F.coalesce("day_to", day))
    met = dated.join(rows, (dated["_month"] == rows["_month"]) & in_force, "left")
    return met.select(*[dated[c] for c in requests.columns], "cap_days")


def _gate(requests: DataFrame, window_days: int, initial_cap: int, schedule) -> tuple[DataFrame, Column, Column]:
    """(requests, violation of A9, its detail); the schedule is a list of (lo, hi, cap) or a dated table."""
    d, r = F.col("days_in_treatment"), F.col("requested_days")
    if isinstance(schedule, DataFrame):
        requests, cap = scheduled_caps(requests, schedule), F.col("cap_days")
    else:
        cap = cap_days(d, schedule)
    early = (d < window_days) & (r > initial_cap)
    unsigned = ~F.coalesce(F.col("assessment_signed"), F.lit(False))
    over_cap = F.coalesce(r > cap, F.lit(False))
    detail = F.concat_ws(",", F.when(early, F.lit("early")), F.when(unsigned, F.lit("unsigned")), F.when(over_cap, F.lit("over_cap")))
    return requests, early | unsigned | over_cap, detail


def takehome_gate(requests: DataFrame, window_days: int = 14, initial_cap: int = 7, schedule=CAP_SCHEDULE) -> DataFrame:
    """A9 (R-FED-05): block if (days < 14 and requested > 7) or the stability
    assessment is not signed; later requests are held to the cap schedule."""
    requests, bad, detail = _gate(requests, window_days, initial_cap, schedule)
    return finding(requests.filter(bad), "R-FED-05", F.col("request_id"), F.col("request_date"), detail)


def takehome_checks(requests: DataFrame, window_days: int = 14, initial_cap: int = 7, schedule=CAP_SCHEDULE) -> DataFrame:
    """A8 and A9 over the same requests in one pass."""
    requests, bad, detail = _gate(requests, window_days, initial_cap, schedule)
    key, day = F.col("request_id"), F.col("request_date")
    return findings_one_pass(requests, [
        ("R-FED-04", ~F.coalesce(F.col("stable_home"), F.lit(False)), key, day, F.lit("stable_home not documented")),
        ("R-FED-05", bad, key, day, detail),
    ])


def counseling_minimum(narratives: DataFrame, min_minutes: int = 15) -> DataFrame:
    """A14 (R-SIMPLY-01): documented minutes below the minimum; no minutes found, no finding."""
    from regloom.operators.extract import min_counseling

    m = narratives.select("*", min_counseling(F.col("text")).alias("_m"))
    bad = m.filter(F.col("_m") < min_minutes)
    return finding(bad, "R-SIMPLY-01", F.col("record_id"), None, F.concat(F.lit("minutes="), F.col("_m").cast("string")))


def intake_fields(records: DataFrame, required: Sequence[str]) -> DataFrame:
    """A15 (R-FASAMS-01): list of required fields that are null or blank."""
    missing = F.filter(
        F.array(*[F.when(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "", F.lit(c)) for c in required]),
        lambda x: x.isNotNull(),
    )
    m = records.select("*", missing.alias("_missing")).filter(F.size("_missing") > 0)
    return finding(m, "R-FASAMS-01", F.col("record_id"), None, F.array_join("_missing", ","))


def expiry_warning(records: DataFrame, rule_id: str, as_of: str, window_days: int) -> DataFrame:
    """A16 (R-FASAMS-02, 30 days) and A20 (R-TPLAN-01, 14 days): due within the
    window, lapsed ones included."""
    left = F.datediff(F.col("expiry_date"), F.to_date(F.lit(as_of)))
    bad = records.select("*", left.alias("_left")).filter(F.col("_left") <= window_days)
    return finding(bad, rule_id, F.col("record_id"), F.col("expiry_date"), F.concat(F.lit("days_left="), F.col("_left").cast("string")))


def regional_modifier(claims: DataFrame, patient_region: DataFrame, routing: DataFrame) -> DataFrame:
    """A17 (R-MSO-01): the line must carry its patient's regional modifier.

    ``patient_region``: patient_id, region; ``routing``: region, modifier (left
    to AQE, which measures it). A patient without a region can't be routed, so
    every line is reported; a region without a modifier asks for none."""
    regions = patient_region.join(routing, "region", "left").select("patient_id", "region", "modifier")
    j = claims.join(regions, "patient_id", "left")
    bad = j.filter(F.col("region").isNull() | ~F.array_contains(_mods(), F.col("modifier")))
    detail = F.when(F.col("region").isNull(), F.lit("no region")).otherwise(F.concat(F.lit("needs="), F.col("modifier")))
    return finding(bad, "R-MSO-01", _claim_key(), F.col("service_date"), detail)


def pdmp_gate(visits: DataFrame) -> DataFrame:
    """A18 (R-PDMP-01): a prescription needs an earlier PDMP query for the
    patient; any earlier query counts. The earliest query per patient is a
    partial aggregate, so the check is one equi-join."""
    first_q = visits.filter(F.col("kind") == "PDMP_QUERY").groupBy("patient_id").agg(F.min("ts").alias("first_query"))
    rx = visits.filter(F.col("kind") == "PRESCRIBE")
    j = rx.join(first_q, "patient_id", "left")
    bad = j.filter(~F.coalesce(F.col("first_query") < F.col("ts"), F.lit(False)))
    return finding(bad, "R-PDMP-01", F.col("event_id"), F.col("service_date"), F.lit("no earlier PDMP query"))


def credentialing(sessions: DataFrame) -> DataFrame:
    """A19 (R-CRED-01): unlicensed counselor without a supervisor of record."""
    bad = sessions.filter(~F.coalesce(F.col("licensed"), F.lit(False)) & F.col("supervisor_id").isNull())
    return finding(bad, "R-CRED-01", F.col("session_id"), F.col("service_date"), F.lit("unsupervised"))


def order_findings(findings: DataFrame) -> DataFrame:
    """Federal findings first, then by rule, record and day (a range-partitioned
    global sort, not one task)."""
    fed = F.when(F.col("rule_id").startswith("R-FED-"), F.lit(0)).otherwise(F.lit(1))
    return findings.orderBy(fed, "rule_id", "record_key", "finding_date", "detail")


def run_audits(
    claims: DataFrame | None = None,
    visits: DataFrame | None = None,
    vault: DataFrame | None = None,
    pairs: DataFrame | None = None,
    allowed_g_codes: DataFrame | None = None,
    *,
    admissions: DataFrame | None = None,
    requests: DataFrame | None = None,
    narratives: DataFrame | None = None,
    intakes: DataFrame | None = None,
    required_fields: Sequence[str] = (),
    eligibility: DataFrame | None = None,
    plans: DataFrame | None = None,
    as_of: str | None = None,
    patient_region: DataFrame | None = None,
    routing: DataFrame | None = None,
    sessions: DataFrame | None = None,
) -> DataFrame:
    """Every check (A1-A20) whose inputs are given, as one findings table, federal first.

    ``intakes`` need ``required_fields``; ``eligibility`` (30 days) and ``plans``
    (14 days) need ``as_of``; ``patient_region`` and ``routing`` go together.
    Each check is its own narrow/aggregate plan; the union adds no shuffle."""
    parts: list[DataFrame] = []
    if claims is not None:
        parts += [bundle_and_iop(claims), claim_line_checks(claims)]
        if pairs is not None:
            parts.append(same_day_pairs(claims, pairs))
        if allowed_g_codes is not None:
            parts += [payer_blocker(claims, allowed_g_codes), standard_codes(claims)]
        if patient_region is not None and routing is not None:
            parts.append(regional_modifier(claims, patient_region, routing))
    if visits is not None:
        parts += [dosing_counseling_ratio(visits), pdmp_gate(visits)]
    if vault is not None:
        parts.append(vault_reconciliation(vault))
    if admissions is not None:
        parts.append(admission_eligibility(admissions))
    if requests is not None:
        parts.append(takehome_checks(requests))
    if narratives is not None:
        parts.append(counseling_minimum(narratives))
    if intakes is not None:
        if not required_fields:
            raise ValueError("intakes need required_fields")
        parts.append(intake_fields(intakes, required_fields))
    for records, rule_id, days in ((eligibility, "R-FASAMS-02", 30), (plans, "R-TPLAN-01", 14)):
        if records is not None:
            if as_of is None:
                raise ValueError(f"{rule_id} needs as_of")
            parts.append(expiry_warning(records, rule_id, as_of, days))
    if sessions is not None:
        parts.append(credentialing(sessions))
    if (patient_region is None) != (routing is None) or (routing is not None and claims is None):
        raise ValueError("R-MSO-01 needs claims, patient_region and routing")
    if not parts:
        raise ValueError("no audit inputs given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return order_findings(out)
