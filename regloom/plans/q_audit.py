"""Audit queries (A1-A20) over fx_claims, fx_visits, fx_vault and TPC-H dims.

Record attributes the fixtures lack (take-home requests, licences, expiry
dates, regional modifiers) are derived from the same tables by fixed rules,
so every check runs over data that grows with its source table.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regloom.operators import audit as A
from regloom.operators import extract as X
from regloom.operators import ptp as P
from regloom.plans.q_ptp import raw_rows
from regloom.plans.registry import _REGISTRY, register
from regloom.sources import fixtures as FX
from regloom.sources.tables import Tables

_BUNDLE_SQL = ", ".join(f"'{c}'" for c in A.BUNDLE_CODES)
_SUD_SQL = ", ".join(f"'{c}'" for c in A.SUD_CODES)


def _finding_sql(rule_id: str, key: str, day: str | None, detail: str) -> str:
    d = f"strftime({day}, '%Y-%m-%d')" if day else "cast(null as varchar)"
    return (
        f"select '{rule_id}' as rule_id, cast({key} as varchar) as record_key, {d} as finding_date, "
        f"'{A.severity(rule_id)}' as severity, {detail} as detail"
    )


def _claims(spark, sf_dir) -> DataFrame:
    t = Tables(spark, sf_dir)
    return FX.fx_claims(t.lineitem, t.orders)


_CLAIM_KEY = "cast(claim_id as varchar) || ':' || cast(line_no as varchar)"


@register(
    "audit_bundle_iop",
    covers=("A1", "A2"),
    oracle=FX.with_fixtures(
        f""",
d as (select patient_id, service_date,
             count(*) filter (where code in ({_BUNDLE_SQL})) as bundle_lines,
             count(*) filter (where code not in ({_BUNDLE_SQL})) as non_bundle_lines,
             count(*) filter (where code = 'G0137') as iop_lines,
             count(*) filter (where code <> 'G0137') as non_iop_lines
      from fx_claims group by patient_id, service_date),
w as (select *,
        sum(non_bundle_lines) over (partition by patient_id order by service_date
                                    range between interval 6 days preceding and current row) as bw,
        sum(non_iop_lines) over (partition by patient_id order by service_date
                                 range between interval 6 days preceding and current row) as iw
      from d)
{_finding_sql('R-FED-01', 'patient_id', 'service_date', "'services_in_window=' || cast(bw as varchar)")} from w where bundle_lines > 0 and bw < 1
union all
{_finding_sql('R-FED-02', 'patient_id', 'service_date', "'services_in_window=' || cast(iw as varchar)")} from w where iop_lines > 0 and iw < 9""",
        "fx_claims",
    ),
)
def q_audit_bundle_iop(spark, sf_dir):
    return A.bundle_and_iop(_claims(spark, sf_dir))


@register(
    "audit_dosing_ratio",
    covers=("A6",),
    oracle=FX.with_fixtures(
        f""",
d as (select patient_id, service_date, count(*) filter (where kind = 'DOSING') as dosing,
             count(*) filter (where kind = 'COUNSELING') as counseling
      from fx_visits group by patient_id, service_date),
w as (select *, sum(counseling) over (partition by patient_id order by service_date
                                      range between interval 29 days preceding and current row) as c from d)
{_finding_sql('R-FL-05', 'patient_id', 'service_date', "'counseling_in_window=' || cast(c as varchar)")} from w where dosing > 0 and c < 1""",
        "fx_visits",
    ),
)
def q_audit_dosing_ratio(spark, sf_dir):
    return A.dosing_counseling_ratio(FX.fx_visits(Tables(spark, sf_dir).events))


@register(
    "audit_claim_lines",
    covers=("A3", "A4", "A5", "A13"),
    oracle=FX.with_fixtures(
        f""",
c as (select *, list_filter(string_split(coalesce(modifiers_csv, ''), ','), lambda m: m <> '') as mods,
             list_filter(string_split(coalesce(dx, ''), ','), lambda x: x like 'O%') <> [] as pregnant from fx_claims)
{_finding_sql('R-FL-02', _CLAIM_KEY, 'service_date', "'pos=' || coalesce(pos, 'null')")} from c where code = 'H0020' and not coalesce(pos = '58', false)
union all
{_finding_sql('R-FL-03', _CLAIM_KEY, 'service_date', "'modifiers=' || coalesce(modifiers_csv, '')")} from c where code in ({_SUD_SQL}) and not list_contains(mods, 'HF')
union all
{_finding_sql('R-FL-04', _CLAIM_KEY, 'service_date', "case when pregnant then 'pregnant ' else '' end || 'modifiers=' || coalesce(modifiers_csv, '')")}
from c where code = 'H0020' and not (case when pregnant
    then list_position(mods, 'HD') is not null and list_position(mods, 'HG') is not null and list_position(mods, 'HD') < list_position(mods, 'HG')
    else list_position(mods, 'HG') is not null and list_position(mods, 'HD') is null end)
union all
{_finding_sql('R-SUNSHINE-01', _CLAIM_KEY, 'service_date', "'dx=' || coalesce(dx, '')")}
from c where regexp_matches(code, '^H[0-9]{{4}}$')
  and list_filter(string_split(coalesce(dx, ''), ','), lambda x: x like 'F11.2%') = []""",
        "fx_claims",
    ),
)
def q_audit_claim_lines(spark, sf_dir):
    return A.claim_line_checks(_claims(spark, sf_dir))


def _sub(name: str) -> str:
    return f"({_REGISTRY[name].oracle.strip()})"


@register(
    "audit_same_day_pairs",
    covers=("A11",),
    oracle=FX.with_fixtures(
        f""",
pairs as (select distinct column1, column2 from {_sub('ptp_relevant_edits')} e),
codes as (select column1 as code from pairs union select column2 from pairs),
dc as (select distinct patient_id, service_date, code from fx_claims where code in (select code from codes)),
hits as (select distinct a.patient_id, a.service_date, p.column1, p.column2
         from dc a join pairs p on a.code = p.column1
         join dc b on b.patient_id = a.patient_id and b.service_date = a.service_date and b.code = p.column2)
{_finding_sql('R-NCCI', 'patient_id', 'service_date', "column1 || '+' || column2")} from hits""",
        "fx_claims",
    ),
)
def q_audit_same_day_pairs(spark, sf_dir):
    pairs = P.relevant_edits(raw_rows(Tables(spark, sf_dir).part))
    return A.same_day_pairs(_claims(spark, sf_dir), pairs)


@register(
    "audit_payer_blocker",
    covers=("A12",),
    oracle=FX.with_fixtures(
        f""",
allowed as (select distinct unnest(regexp_extract_all(text, '{X.RE_G_CODE_CMS}', 1)) as code from fx_source_text)
{_finding_sql('R-FLMAC-01', _CLAIM_KEY, 'service_date', "'code=' || code")}
from fx_claims where regexp_matches(code, '^G[0-9]{{4}}$') and code not in (select code from allowed)
  and exists (select 1 from allowed)""",
        "fx_claims",
        "fx_source_text",
    ),
)
def q_audit_payer_blocker(spark, sf_dir):
    docs = FX.fx_source_text(Tables(spark, sf_dir).documents)
    allowed = docs.select(F.explode(X.cms_g_codes(F.col("text"))).alias("code"))
    return A.payer_blocker(_claims(spark, sf_dir), allowed)


@register(
    "audit_standard_codes",
    covers=("A12",),
    oracle=FX.with_fixtures(
        f"""
{_finding_sql('R-FLMAC-01', _CLAIM_KEY, 'service_date', "'standard code=' || code")}
from fx_claims where not regexp_matches(code, '^G[0-9]{{4}}$') and claim_id in (select claim_id from fx_claims where code between 'G2067' and 'G2079')""",
        "fx_claims",
    ),
)
def q_audit_standard_codes(spark, sf_dir):
    """A12, the other half: standard codes on claims that bill an OTP bundle."""
    return A.standard_codes(_claims(spark, sf_dir))


def vault_counts(vault: DataFrame) -> DataFrame:
    """Physical counts for fx_vault: running stock plus the planted variance."""
    w = Window.partitionBy("vault_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    net = F.col("received") - F.col("dispensed") - F.col("wasted")
    return vault.select("*", (F.sum(net).over(w) + F.col("planted_variance")).alias("physical_count"))


@register(
    "audit_vault",
    covers=("A10",),
    oracle=FX.with_fixtures(
        f""",
p as (select *, sum(received - dispensed - wasted) over (partition by vault_id order by day rows between unbounded preceding and current row)
                + planted_variance as physical_count from fx_vault),
b as (select *, coalesce(lag(physical_count) over (partition by vault_id order by day), 0) as begin_count from p),
v as (select *, physical_count - (begin_count + received - dispensed - wasted) as variance from b)
{_finding_sql('R-FED-06', 'vault_id', 'day', "'variance=' || cast(variance as varchar)")} from v where abs(variance) > 0""",
        "fx_vault",
    ),
)
def q_audit_vault(spark, sf_dir):
    return A.vault_reconciliation(vault_counts(FX.fx_vault(Tables(spark, sf_dir).events)))


@register(
    "audit_pdmp",
    covers=("A18",),
    oracle=FX.with_fixtures(
        f""",
q as (select patient_id, min(ts) as first_query from fx_visits where kind = 'PDMP_QUERY' group by patient_id),
rx as (select v.*, q.first_query from fx_visits v left join q using (patient_id) where kind = 'PRESCRIBE')
{_finding_sql('R-PDMP-01', 'event_id', 'service_date', "'no earlier PDMP query'")} from rx
where not coalesce(first_query < ts, false)""",
        "fx_visits",
    ),
)
def q_audit_pdmp(spark, sf_dir):
    return A.pdmp_gate(FX.fx_visits(Tables(spark, sf_dir).events))


def takehome_requests(visits: DataFrame) -> DataFrame:
    """Take-home requests derived from PRESCRIBE visits."""
    first = visits.groupBy("patient_id").agg(F.min("service_date").alias("first_day"))
    rx = visits.filter(F.col("kind") == "PRESCRIBE").join(first, "patient_id")
    e = F.col("event_id")
    return rx.select(
        e.alias("request_id"),
        "patient_id",
        F.col("service_date").alias("request_date"),
        F.datediff("service_date", "first_day").alias("days_in_treatment"),
        (F.floor("value").cast("bigint") % 35).alias("requested_days"),
        F.when(e % 4 == 0, F.lit(None).cast("boolean")).when(e % 4 == 1, F.lit(False)).otherwise(F.lit(True)).alias("stable_home"),
        (e % 6 != 0).alias("assessment_signed"),
    )


_REQ_SQL = """,
first_day as (select patient_id, min(service_date) as first_day from fx_visits group by patient_id),
req as (select event_id as request_id, patient_id, service_date as request_date,
               datediff('day', first_day, service_date) as days_in_treatment,
               cast(floor(value) as bigint) % 35 as requested_days,
               case when event_id % 4 = 0 then null when event_id % 4 = 1 then false else true end as stable_home,
               event_id % 6 <> 0 as assessment_signed
        from fx_visits join first_day using (patient_id) where kind = 'PRESCRIBE')
"""


@register(
    "audit_takehome",
    covers=("A8", "A9"),
    oracle=FX.with_fixtures(
        _REQ_SQL
        + f"""
{_finding_sql('R-FED-04', 'request_id', 'request_date', "'stable_home not documented'")} from req where not coalesce(stable_home, false)
union all
{_finding_sql('R-FED-05', 'request_id', 'request_date',
              "concat_ws(',', case when days_in_treatment < 14 and requested_days > 7 then 'early' end, "
              "case when not coalesce(assessment_signed, false) then 'unsigned' end, "
              "case when requested_days > (case when days_in_treatment <= 14 then 7 when days_in_treatment <= 31 then 14 else 28 end) then 'over_cap' end)")}
from req where (days_in_treatment < 14 and requested_days > 7) or not coalesce(assessment_signed, false)
   or requested_days > (case when days_in_treatment <= 14 then 7 when days_in_treatment <= 31 then 14 else 28 end)""",
        "fx_visits",
    ),
)
def q_audit_takehome(spark, sf_dir):
    return A.takehome_checks(takehome_requests(FX.fx_visits(Tables(spark, sf_dir).events)))


#: A cap schedule that changes twice (effective_from, effective_to, day_from, day_to, cap_days); the days from the 25th on have none for 10 to 12 days.
SCHEDULE = [
    ("2023-01-01", "2024-01-10", 0, 14, 7), ("2023-01-01", "2024-01-10", 15, 31, 14), ("2023-01-01", "2024-01-10", 32, None, 28),
    ("2024-01-11", "2024-01-24", 0, 5, 3), ("2024-01-11", "2024-01-24", 6, None, 21),
    ("2024-01-25", None, 0, 9, 10), ("2024-01-25", None, 13, None, 30),
]
_SCHEDULE_SQL = ", ".join(f"(date '{a}', {f'date {b!r}' if b else 'cast(null as date)'}, {lo}, {'null' if hi is None else hi}, {cap})" for a, b, lo, hi, cap in SCHEDULE)


@register(
    "audit_takehome_schedule",
    covers=("A9",),
    oracle=FX.with_fixtures(
        _REQ_SQL
        + f""",
schedule as (select * from (values {_SCHEDULE_SQL}) as v(effective_from, effective_to, day_from, day_to, cap_days)),
capped as (
  select req.*, cap_days from req left join schedule
    on request_date between effective_from and coalesce(effective_to, date '2999-01-01') and days_in_treatment between day_from and coalesce(day_to, 100000)),
f as (select *, concat_ws(',', case when days_in_treatment < 14 and requested_days > 7 then 'early' end,
                               case when not coalesce(assessment_signed, false) then 'unsigned' end, case when requested_days > cap_days then 'over_cap' end) as why from capped)
{_finding_sql('R-FED-05', 'request_id', 'request_date', 'why')} from f where why <> ''""",
        "fx_visits",
    ),
)
def q_audit_takehome_schedule(spark, sf_dir):
    rows = spark.createDataFrame(SCHEDULE, "effective_from string, effective_to string, day_from int, day_to int, cap_days int")
    schedule = rows.withColumns({c: F.col(c).cast("date") for c in ("effective_from", "effective_to")})
    return A.takehome_gate(takehome_requests(FX.fx_visits(Tables(spark, sf_dir).events)), schedule=schedule)


@register(
    "audit_admission",
    covers=("A7",),
    oracle=FX.with_fixtures(
        f""",
a as (select patient_id, min(date_trunc('month', service_date)) filter (where kind = 'DOSING') as admission_date from fx_visits group by patient_id),
m as (select *, case when patient_id % 10 <> 3 then patient_id % 25 end as months from a where admission_date is not null)
{_finding_sql('R-FED-03', 'patient_id', 'cast(admission_date as date)', "'months=' || coalesce(cast(cast(months as double) as varchar), 'none')")}
from m where coalesce(months, 0) < 12 and patient_id % 7 <> 0""",
        "fx_visits",
    ),
)
def q_audit_admission(spark, sf_dir):
    """Admissions in the month of the first dosing; histories of 0 to 24 months, some not documented, some with an exception."""
    v = FX.fx_visits(Tables(spark, sf_dir).events)
    p = F.col("patient_id")
    adm = v.groupBy("patient_id").agg(F.min(F.when(F.col("kind") == "DOSING", F.trunc("service_date", "MM"))).alias("admission_date")).filter(F.col("admission_date").isNotNull())
    adm = adm.select(
        "*",
        F.when(p % 10 != 3, F.add_months("admission_date", -(p % 25).cast("int"))).alias("history_start"),
        F.when(p % 7 == 0, F.array(F.lit("pregnancy"))).otherwise(F.array().cast("array<string>")).alias("exceptions"),
    )
    return A.admission_eligibility(adm)


def intake_records(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.alias("record_id"),
        F.when(k % 11 != 0, F.col("c_name")).alias("name"),
        F.when(k % 13 != 0, F.col("c_mktsegment")).alias("employment"),
        F.col("c_nationkey").alias("demographic"),
        F.date_add(F.to_date(F.lit("2024-01-01")), (k % 90).cast("int")).alias("expiry_date"),
    )


@register(
    "audit_intake_fields",
    covers=("A15",),
    oracle=f"""
with r as (select c_custkey as record_id, case when c_custkey % 11 <> 0 then c_name end as name,
                  case when c_custkey % 13 <> 0 then c_mktsegment end as employment, c_nationkey as demographic from customer),
m as (select record_id, list_filter([case when trim(coalesce(name, '')) = '' then 'name' end,
                                     case when trim(coalesce(employment, '')) = '' then 'employment' end,
                                     case when trim(coalesce(cast(demographic as varchar), '')) = '' then 'demographic' end],
                                    lambda x: x is not null) as missing from r)
{_finding_sql('R-FASAMS-01', 'record_id', None, "array_to_string(missing, ',')")} from m where len(missing) > 0""",
)
def q_audit_intake_fields(spark, sf_dir):
    return A.intake_fields(intake_records(Tables(spark, sf_dir).customer), ["name", "employment", "demographic"])


@register(
    "audit_eligibility_expiry",
    covers=("A16",),
    oracle=f"""
with r as (select c_custkey as record_id, date '2024-01-01' + cast(c_custkey % 90 as integer) as expiry_date from customer),
d as (select *, datediff('day', date '2024-01-15', expiry_date) as left_days from r)
{_finding_sql('R-FASAMS-02', 'record_id', 'expiry_date', "'days_left=' || cast(left_days as varchar)")} from d where left_days <= 30""",
)
def q_audit_eligibility_expiry(spark, sf_dir):
    return A.expiry_warning(intake_records(Tables(spark, sf_dir).customer), "R-FASAMS-02", "2024-01-15", 30)


@register(
    "audit_plan_expiry",
    covers=("A20",),
    oracle=FX.with_fixtures(
        f""",
r as (select patient_id as record_id, max(service_date) + 30 as expiry_date from fx_visits group by patient_id),
d as (select *, datediff('day', date '2024-02-20', expiry_date) as left_days from r)
{_finding_sql('R-TPLAN-01', 'record_id', 'expiry_date', "'days_left=' || cast(left_days as varchar)")} from d where left_days <= 14""",
        "fx_visits",
    ),
)
def q_audit_plan_expiry(spark, sf_dir):
    v = FX.fx_visits(Tables(spark, sf_dir).events)
    plans = v.groupBy(F.col("patient_id").alias("record_id")).agg(F.date_add(F.max("service_date"), 30).alias("expiry_date"))
    return A.expiry_warning(plans, "R-TPLAN-01", "2024-02-20", 14)


@register(
    "audit_regional_modifier",
    covers=("A17",),
    oracle=FX.with_fixtures(
        f""",
c2 as (select *, case when line_no % 2 = 0 then modifiers_csv || ',U' || cast(patient_id % 5 + 1 as varchar) else modifiers_csv end as mods_csv
       from fx_claims),
pr as (select c_custkey as patient_id, n_regionkey as region from customer join nation on c_nationkey = n_nationkey where c_custkey % 17 <> 0),
rt as (select r_regionkey as region, 'U' || cast(r_regionkey + 1 as varchar) as modifier from region),
j as (select c2.*, pr.region, rt.modifier from c2 left join pr using (patient_id) left join rt using (region))
{_finding_sql('R-MSO-01', _CLAIM_KEY, 'service_date', "case when region is null then 'no region' else 'needs=' || modifier end")}
from j where region is null or not list_contains(list_filter(string_split(coalesce(mods_csv, ''), ','), lambda m: m <> ''), modifier)""",
        "fx_claims",
    ),
)
def q_audit_regional_modifier(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = _claims(spark, sf_dir)
    c = c.withColumn(
        "modifiers_csv",
        F.when(F.col("line_no") % 2 == 0, F.concat(F.col("modifiers_csv"), F.lit(",U"), (F.col("patient_id") % 5 + 1).cast("string")))
        .otherwise(F.col("modifiers_csv")),
    )
    # nation and region have a fixed size (25 and 5 rows), so broadcasting them is safe.
    pr = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("patient_id"), F.col("n_regionkey").alias("region")
    ).where(F.col("patient_id") % 17 != 0)
    routing = t.region.select(
        F.col("r_regionkey").alias("region"), F.concat(F.lit("U"), (F.col("r_regionkey") + 1).cast("string")).alias("modifier")
    )
    return A.regional_modifier(c, pr, routing)


@register(
    "audit_credentialing",
    covers=("A19",),
    oracle=FX.with_fixtures(
        f""",
s as (select event_id as session_id, service_date, event_id % 3 <> 0 as licensed,
             case when event_id % 5 = 0 then patient_id end as supervisor_id from fx_visits where kind = 'COUNSELING')
{_finding_sql('R-CRED-01', 'session_id', 'service_date', "'unsupervised'")} from s where not coalesce(licensed, false) and supervisor_id is null""",
        "fx_visits",
    ),
)
def q_audit_credentialing(spark, sf_dir):
    v = FX.fx_visits(Tables(spark, sf_dir).events).filter(F.col("kind") == "COUNSELING")
    e = F.col("event_id")
    s = v.select(
        e.alias("session_id"), "service_date", (e % 3 != 0).alias("licensed"),
        F.when(e % 5 == 0, F.col("patient_id")).alias("supervisor_id"),
    )
    return A.credentialing(s)


_PLACEHOLDER = "[ Grab your reader's attention with 5 min of counseling here. ]"
_NARRATIVES_SQL = f""",
n as (
  select doc_id, case doc_id % 5 when 0 then '{_PLACEHOLDER.replace("'", "''")}' || chr(10) || '  ' || text
                                 when 1 then text || ' 10 minutes of counseling.' when 2 then text || ' Session: 8 min therapy and 30 min therapy.' else text end as text
  from fx_source_text),
stripped as (select doc_id, regexp_replace(regexp_replace(text, '(?i){X.RE_TEMPLATE_PLACEHOLDER}', '', 'g'), '^\\s+', '') as text from n)"""


def narratives(documents: DataFrame) -> DataFrame:
    """Narratives with documented minutes below and above the minimum, some of them behind a template's placeholder (whose minutes do not count)."""
    k, t = F.col("doc_id") % 5, F.col("text")
    text = (
        F.when(k == 0, F.concat(F.lit(_PLACEHOLDER + "\n  "), t)).when(k == 1, F.concat(t, F.lit(" 10 minutes of counseling.")))
        .when(k == 2, F.concat(t, F.lit(" Session: 8 min therapy and 30 min therapy."))).otherwise(t)
    )
    return FX.fx_source_text(documents).select(F.col("doc_id").alias("record_id"), X.strip_template(text).alias("text"))


@register("narratives_stripped", covers=("X9",), oracle=FX.with_fixtures(_NARRATIVES_SQL + "\nselect doc_id as record_id, text from stripped", "fx_source_text"))
def q_narratives_stripped(spark, sf_dir):
    return narratives(Tables(spark, sf_dir).documents)


@register(
    "audit_counseling_minutes",
    covers=("A14", "X7"),
    oracle=FX.with_fixtures(
        f"""{_NARRATIVES_SQL},
m as (select doc_id, list_min(list_transform(regexp_extract_all(text, '(?i){X.RE_COUNSELING_TIME}', 1), lambda x: try_cast(x as integer))) as mn from stripped)
{_finding_sql('R-SIMPLY-01', 'doc_id', None, "'minutes=' || cast(mn as varchar)")} from m where mn < 15""",
        "fx_source_text",
    ),
)
def q_audit_counseling_minutes(spark, sf_dir):
    return A.counseling_minimum(narratives(Tables(spark, sf_dir).documents))
