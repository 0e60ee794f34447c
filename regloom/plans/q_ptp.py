"""PTP queries (P1-P6, S5) over fx_ptp_rows."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.operators import ptp as P
from regloom.plans.registry import register
from regloom.sources import fixtures as FX
from regloom.sources.tables import Tables

CODES_SQL = ", ".join(f"'{c}'" for c in P.RELEVANT_CODES)


def raw_rows(part: DataFrame) -> DataFrame:
    """fx_ptp_rows in the raw-row shape: full-table layout, indicator in cell 2 or 5."""
    fx = FX.fx_ptp_rows(part)
    return fx.select(
        F.lit(0).alias("part_ord"),
        "file_ord",
        "member",
        F.when(F.col("member").endswith(".xlsx"), F.lit("Sheet1")).alias("sheet"),
        "row_ord",
        F.array("c1", "c2", "c3", F.lit(""), F.lit(""), "c6").alias("cells"),
    )


_STAGED_SQL = rf""",
r as (
  select row_ord, file_ord, member,
         regexp_replace(coalesce(c1, ''), '^\s+|\s+$', '', 'g') as column1,
         regexp_replace(coalesce(c2, ''), '^\s+|\s+$', '', 'g') as column2,
         case when lower(member) like '%.txt' and lower(member) like '%additions%' then 'addition'
              when lower(member) like '%.txt' and lower(member) like '%deletions%' then 'deletion'
              when lower(member) like '%.xlsx' then
                case when lower('Sheet1 ' || member) like '%add%' then 'addition'
                     when lower('Sheet1 ' || member) like '%del%' then 'deletion'
                     when lower('Sheet1 ' || member) similar to '.*(ccmi|chg|change).*' then 'ccmi_change'
                     else 'ptp_edit' end
         end as edit_kind,
         case when lower(member) like '%.xlsx' then member || '#Sheet1' else member end as source_file,
         coalesce(list_filter(list_transform([c3, '', '', c6],
             lambda x: regexp_replace(split_part(regexp_replace(x, '^\s+|\s+$', '', 'g'), chr(10), 1), '^\s+|\s+$', '', 'g')),
             lambda x: x in ('0', '1', '9'))[1], '') as modifier_indicator
  from fx_ptp_rows),
f as (
  select * from r
  where edit_kind is not null
    and regexp_matches(column1, '^[A-Z0-9]{{5}}$') and regexp_matches(column2, '^[A-Z0-9]{{5}}$')
    and (column1 in ({CODES_SQL}) or column2 in ({CODES_SQL}))),
d as (
  select * from (
    select *, row_number() over (partition by column1, column2, edit_kind order by file_ord, row_ord) as rn from f)
  where rn = 1)
"""


@register(
    "ptp_relevant_edits",
    covers=("P1", "P2", "P3", "P4", "P5", "P6"),
    oracle=FX.with_fixtures(
        _STAGED_SQL
        + """
select column1, column2, modifier_indicator, edit_kind, source_file, file_ord, row_ord from d""",
        "fx_ptp_rows",
    ),
)
def q_ptp_relevant_edits(spark, sf_dir):
    edits = P.relevant_edits(raw_rows(Tables(spark, sf_dir).part))
    return edits.select(*P.EDIT_COLUMNS, "file_ord", "row_ord")


@register(
    "ptp_scan_summary",
    covers=("P6", "S5"),
    oracle=FX.with_fixtures(
        _STAGED_SQL
        + """,
parts as (select distinct file_ord, member from fx_ptp_rows),
dig as (select sha256(string_agg(sha256(member), '' order by file_ord)) as combined_sha256,
               count(*) as part_count from parts)
select (select count(*) from d) as edit_count_relevant, combined_sha256, part_count from dig""",
        "fx_ptp_rows",
    ),
)
def q_ptp_scan_summary(spark, sf_dir):
    raw = raw_rows(Tables(spark, sf_dir).part)
    edits = P.relevant_edits(raw)
    # Part digests stand in for the downloaded payloads: one per member.
    parts = raw.select(F.col("file_ord").alias("part_ord"), "member").distinct().select(
        "part_ord", F.sha2(F.col("member"), 256).alias("digest")
    )
    return P.scan_summary(edits, parts)
