"""Fixture views derived from the driver's tables (FIXTURES.md section 2).

Each view exists twice: as a DataFrame builder (what the Spark queries use)
and as SQL text (what the DuckDB oracles use as a CTE). The SQL is the
published fixture definition; the builders express the same rows with the
DataFrame API. All of them are narrow projections of one table, except
fx_claims (one equi-join) and fx_vault (one aggregation), so they scale with
the input.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regloom.sources.tables import Tables



def _case(expr: Column, mapping: list[tuple[int, object]], default) -> Column:
    out = None
    for k, v in mapping:
        v = v if isinstance(v, Column) else F.lit(v)
        out = F.when(expr == k, v) if out is None else out.when(expr == k, v)
    default = default if isinstance(default, Column) else F.lit(default)
    return out.otherwise(default)


# ---------------------------------------------------------------- DataFrames
def fx_source_text(documents: DataFrame) -> DataFrame:
    """Documents with rule vocabulary injected, one kind per doc_id % 8."""
    t = F.col("text")
    k = F.col("doc_id") % 8
    text = _case(
        k,
        [
            (0, F.concat(t, F.lit(" G0137 requires a minimum of nine distinct services."))),
            (1, F.concat(t, F.lit(" Bill G2067, G2078 and G2067; at least 2 services per 7-day period."))),
            (2, F.concat(t, F.lit(" H0020 and H2010 need F11.20 on the claim. take-home dose"))),
            (3, F.concat(t, F.lit(" a 15 minute counseling visit or 20 min session; 45 minutes of therapy."))),
            (4, F.concat(t, F.lit(" modifier HF applies at POS-58; use HD before HG."))),
            (5, F.concat(t, F.lit(" Z59.01 and Z55.0 with polysubstance and alcohol use."))),
            (6, F.replace(t, F.lit("\n"), F.lit("\n \n"))),
        ],
        t,
    )
    return documents.select(
        "doc_id",
        F.col("source").alias("source_key"),
        F.col("lang").alias("label"),
        text.alias("text"),
    )


def fx_results(documents: DataFrame) -> DataFrame:
    """One scrape result per document."""
    d = F.col("doc_id")
    source_key = _case(
        d % 5,
        [(0, "cms_pub_100_04_ch39"), (1, "cms_pub_100_02_ch17"), (2, "fl_mac_fcso_otp"), (3, "ecfr_42_part_8")],
        "cms_mln_otp_booklet",
    )
    return documents.select(
        d.alias("result_ord"),
        source_key.alias("source_key"),
        F.when(d % 17 == 0, F.lit("scrape_failed: 503")).otherwise(F.lit("")).alias("warning"),
        F.when(d % 10 == 1, F.lit(9)).alias("iop_threshold_services"),
        (d % 23 == 0).alias("parsed_is_empty"),
        F.col("text"),
        F.col("n_chars"),
    )


def fx_ptp_rows(part: DataFrame) -> DataFrame:
    """Raw PTP rows covering every filter and dedupe case."""
    pk = F.col("p_partkey")
    ps = F.col("p_size")
    return part.select(
        pk.alias("row_ord"),
        (ps % 3).alias("file_ord"),
        _case(ps % 3, [(0, "MCR_NCCI_Additions.txt"), (1, "MCR_NCCI_Deletions.txt")], "ccipra-f1.xlsx").alias("member"),
        _case(
            pk % 7,
            [(0, "Column 1"), (1, "\tH0020 "), (2, "h0020"), (3, "G2067"), (4, "99213"), (5, "H0004")],
            "G0137",
        ).alias("c1"),
        _case(pk % 4, [(0, "80305"), (1, "99213"), (2, "G2215")], "0395T").alias("c2"),
        F.when(ps % 2 == 0, (pk % 3).cast("string")).otherwise(F.lit("20260101")).alias("c3"),
        F.when(ps % 2 == 0, F.lit("*")).otherwise(F.lit("9")).alias("c6"),
    )


def fx_rules_live(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    return part.filter(pk % 11 != 0).select(
        F.concat(F.lit("R-"), pk.cast("string")).alias("rule_id"),
        F.col("p_type").alias("payer_type"),
        F.col("p_brand").alias("code"),
        F.col("p_size").alias("min_services"),
        F.lit("live").alias("source_key"),
    )


def fx_rules_candidate(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    return part.filter(pk % 7 != 0).select(
        F.concat(F.lit("R-"), pk.cast("string")).alias("rule_id"),
        F.col("p_type").alias("payer_type"),
        F.col("p_brand").alias("code"),
        F.when(pk % 13 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")).alias("min_services"),
        F.lit("candidate").alias("source_key"),
    )


def fx_claims(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Billing lines: lineitem x orders on the order key (a shuffle join on both
    sides' key; AQE splits a skewed order key)."""
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    od = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    return j.select(
        F.col("l_orderkey").alias("claim_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderdate").cast("date").alias("service_date"),
        _case(
            pk % 8,
            [(0, "H0020"), (1, "80305"), (2, "G2067"), (3, "G0137"), (4, "H0004"), (5, "99213"), (6, "G2078")],
            "H2010",
        ).alias("code"),
        F.when(sk % 4 == 0, F.lit("11")).otherwise(F.lit("58")).alias("pos"),
        _case(pk % 5, [(0, "HF"), (1, "HD,HG"), (2, "HG,HD"), (3, "HG")], "").alias("modifiers_csv"),
        _case(sk % 3, [(0, "F11.20"), (1, "O99.320")], "Z59.00").alias("dx"),
    )


def fx_visits(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    kind = (
        F.when(et == "click", "DOSING")
        .when(et == "view", "COUNSELING")
        .when(et == "purchase", "PRESCRIBE")
        .when(et == "signup", "PDMP_QUERY")
        .otherwise("OTHER")
    )
    return events.select(
        "event_id",
        F.col("user_id").alias("patient_id"),
        "ts",
        F.col("ts").cast("date").alias("service_date"),
        kind.alias("kind"),
        "value",
    )


def fx_vault(events: DataFrame) -> DataFrame:
    """Daily stock movements per vault, integer units (never floats)."""
    et = F.col("event_type")
    units = F.round(F.col("value") * 100).cast("bigint")
    zero = F.lit(0).cast("bigint")
    return events.groupBy(F.col("user_id").alias("vault_id"), F.col("ts").cast("date").alias("day")).agg(
        F.sum(F.when(et == "signup", units).otherwise(zero)).alias("received"),
        F.sum(F.when(et == "click", units).otherwise(zero)).alias("dispensed"),
        F.sum(F.when(et == "error", units).otherwise(zero)).alias("wasted"),
        F.max(F.when(F.col("event_id") % 9 == 0, 1).otherwise(0)).alias("planted_variance"),
    )


def build(tables: Tables, name: str) -> DataFrame:
    t = tables
    return {
        "fx_source_text": lambda: fx_source_text(t.documents),
        "fx_results": lambda: fx_results(t.documents),
        "fx_ptp_rows": lambda: fx_ptp_rows(t.part),
        "fx_rules_live": lambda: fx_rules_live(t.part),
        "fx_rules_candidate": lambda: fx_rules_candidate(t.part),
        "fx_claims": lambda: fx_claims(t.lineitem, t.orders),
        "fx_visits": lambda: fx_visits(t.events),
        "fx_vault": lambda: fx_vault(t.events),
    }[name]()


# ----------------------------------------------------------------------- SQL
# The published fixture definitions, used verbatim as CTEs by the oracles.
FIXTURE_SQL = {
    "fx_source_text": """
select doc_id, source as source_key, lang as label,
       case doc_id % 8
         when 0 then text || ' G0137 requires a minimum of nine distinct services.'
         when 1 then text || ' Bill G2067, G2078 and G2067; at least 2 services per 7-day period.'
         when 2 then text || ' H0020 and H2010 need F11.20 on the claim. take-home dose'
         when 3 then text || ' a 15 minute counseling visit or 20 min session; 45 minutes of therapy.'
         when 4 then text || ' modifier HF applies at POS-58; use HD before HG.'
         when 5 then text || ' Z59.01 and Z55.0 with polysubstance and alcohol use.'
         when 6 then replace(text, chr(10), chr(10) || ' ' || chr(10))
         else text end as text
from documents""",
    "fx_results": """
select doc_id as result_ord,
       case doc_id % 5 when 0 then 'cms_pub_100_04_ch39' when 1 then 'cms_pub_100_02_ch17'
                       when 2 then 'fl_mac_fcso_otp' when 3 then 'ecfr_42_part_8'
                       else 'cms_mln_otp_booklet' end as source_key,
       case when doc_id % 17 = 0 then 'scrape_failed: 503' else '' end as warning,
       case when doc_id % 10 = 1 then 9 else null end as iop_threshold_services,
       doc_id % 23 = 0 as parsed_is_empty,
       text, n_chars
from documents""",
    "fx_ptp_rows": """
select p_partkey as row_ord, p_size % 3 as file_ord,
       case p_size % 3 when 0 then 'MCR_NCCI_Additions.txt'
                       when 1 then 'MCR_NCCI_Deletions.txt'
                       else 'ccipra-f1.xlsx' end as member,
       case p_partkey % 7 when 0 then 'Column 1' when 1 then chr(9) || 'H0020 '
                          when 2 then 'h0020' when 3 then 'G2067'
                          when 4 then '99213' when 5 then 'H0004' else 'G0137' end as c1,
       case p_partkey % 4 when 0 then '80305' when 1 then '99213'
                          when 2 then 'G2215' else '0395T' end as c2,
       case when p_size % 2 = 0 then cast(p_partkey % 3 as varchar(10)) else '20260101' end as c3,
       case when p_size % 2 = 0 then '*' else '9' end as c6
from part""",
    "fx_rules_live": """
select 'R-' || cast(p_partkey as varchar(20)) as rule_id, p_type as payer_type, p_brand as code,
       p_size as min_services, 'live' as source_key
from part where p_partkey % 11 <> 0""",
    "fx_rules_candidate": """
select 'R-' || cast(p_partkey as varchar(20)) as rule_id, p_type as payer_type, p_brand as code,
       case when p_partkey % 13 = 0 then p_size + 1 else p_size end as min_services,
       'candidate' as source_key
from part where p_partkey % 7 <> 0""",
    "fx_claims": """
select l_orderkey as claim_id, l_linenumber as line_no, o_custkey as patient_id,
       cast(o_orderdate as date) as service_date,
       case l_partkey % 8 when 0 then 'H0020' when 1 then '80305' when 2 then 'G2067'
                          when 3 then 'G0137' when 4 then 'H0004' when 5 then '99213'
                          when 6 then 'G2078' else 'H2010' end as code,
       case when l_suppkey % 4 = 0 then '11' else '58' end as pos,
       case l_partkey % 5 when 0 then 'HF' when 1 then 'HD,HG' when 2 then 'HG,HD'
                          when 3 then 'HG' else '' end as modifiers_csv,
       case l_suppkey % 3 when 0 then 'F11.20' when 1 then 'O99.320' else 'Z59.00' end as dx
from lineitem join orders on l_orderkey = o_orderkey""",
    "fx_visits": """
select event_id, user_id as patient_id, ts, cast(ts as date) as service_date,
       case event_type when 'click' then 'DOSING' when 'view' then 'COUNSELING'
                       when 'purchase' then 'PRESCRIBE' when 'signup' then 'PDMP_QUERY'
                       else 'OTHER' end as kind,
       value
from events""",
    "fx_vault": """
select user_id as vault_id, cast(ts as date) as day,
       sum(case when event_type = 'signup' then cast(round(value * 100) as bigint) else 0 end) as received,
       sum(case when event_type = 'click' then cast(round(value * 100) as bigint) else 0 end) as dispensed,
       sum(case when event_type = 'error' then cast(round(value * 100) as bigint) else 0 end) as wasted,
       max(case when event_id % 9 = 0 then 1 else 0 end) as planted_variance
from events group by user_id, cast(ts as date)""",
}


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named fixture CTEs (DuckDB oracle text)."""
    ctes = ",\n".join(f"{n} as ({FIXTURE_SQL[n].strip()})" for n in names)
    body = sql.strip()
    if body.startswith(","):  # the caller adds more CTEs
        return f"with {ctes}{body}"
    return f"with {ctes}\n{body}"
