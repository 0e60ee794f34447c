"""Diff queries (D1-D6) over fx_rules_live / fx_rules_candidate."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.operators import diff as D
from regloom.plans.registry import register
from regloom.sources import fixtures as FX
from regloom.sources.tables import Tables

COMPARE = ["payer_type", "code", "min_services"]


def _with_ord(rules: DataFrame) -> DataFrame:
    """Matrix order of the fixture rules: the part key inside the id."""
    return rules.withColumn("rule_ord", F.substring("rule_id", 3, 20).cast("bigint"))


def fixture_changes(spark, sf_dir) -> DataFrame:
    t = Tables(spark, sf_dir)
    live = _with_ord(FX.fx_rules_live(t.part))
    cand = _with_ord(FX.fx_rules_candidate(t.part))
    return D.diff_rules(live, cand, COMPARE)


_JOIN_SQL = """,
j as (
  select coalesce(l.rule_id, c.rule_id) as rule_id, l.rule_id is not null as in_live, c.rule_id is not null as in_cand,
         l.payer_type as l_payer, c.payer_type as c_payer, l.code as l_code, c.code as c_code,
         l.min_services as l_min, c.min_services as c_min
  from fx_rules_live l full outer join fx_rules_candidate c on l.rule_id = c.rule_id)
"""


@register(
    "diff_added_removed",
    covers=("D2", "D6"),
    oracle=FX.with_fixtures(
        _JOIN_SQL
        + """
select rule_id, case when in_live then 'rule_removed' else 'rule_added' end as change_type
from j where not (in_live and in_cand)""",
        "fx_rules_live",
        "fx_rules_candidate",
    ),
)
def q_diff_added_removed(spark, sf_dir):
    ch = fixture_changes(spark, sf_dir)
    return ch.filter(F.col("change_type").isin("rule_added", "rule_removed")).select("rule_id", "change_type")


@register(
    "diff_changed_fields",
    covers=("D3",),
    oracle=FX.with_fixtures(
        _JOIN_SQL
        + """
select rule_id, 'values_changed' as change_type, 'root[''payer_type'']' as path, l_payer as old_value, c_payer as new_value
from j where in_live and in_cand and l_payer is distinct from c_payer
union all
select rule_id, 'values_changed', 'root[''code'']', l_code, c_code from j where in_live and in_cand and l_code is distinct from c_code
union all
select rule_id, 'values_changed', 'root[''min_services'']', cast(l_min as varchar), cast(c_min as varchar)
from j where in_live and in_cand and l_min is distinct from c_min""",
        "fx_rules_live",
        "fx_rules_candidate",
    ),
)
def q_diff_changed_fields(spark, sf_dir):
    ch = fixture_changes(spark, sf_dir)
    return ch.filter(~F.col("change_type").isin("rule_added", "rule_removed"))


@register(
    "diff_summary",
    covers=("D4", "D6"),
    oracle=FX.with_fixtures(
        _JOIN_SQL
        + """
select count(*) filter (where in_cand and not in_live) as added_count,
       count(*) filter (where in_live and not in_cand) as removed_count,
       count(*) filter (where in_live and in_cand and (l_payer is distinct from c_payer or l_code is distinct from c_code
                                                      or l_min is distinct from c_min)) as changed_count,
       count(*) filter (where not (in_live and in_cand)
                           or l_payer is distinct from c_payer or l_code is distinct from c_code
                           or l_min is distinct from c_min) > 0 as is_material
from j""",
        "fx_rules_live",
        "fx_rules_candidate",
    ),
)
def q_diff_summary(spark, sf_dir):
    return D.summary(fixture_changes(spark, sf_dir))


@register(
    "diff_first_deploy",
    covers=("D5",),
    oracle=FX.with_fixtures(
        """
select rule_id, 'rule_added' as change_type, cast(substring(rule_id, 3, 20) as bigint) as rule_ord
from fx_rules_candidate""",
        "fx_rules_candidate",
    ),
)
def q_diff_first_deploy(spark, sf_dir):
    cand = _with_ord(FX.fx_rules_candidate(Tables(spark, sf_dir).part))
    return D.first_deploy(cand).select("rule_id", "change_type", "rule_ord")


@register(
    "rules_last_wins",
    covers=("D1",),
    oracle="""
select rule_id, rule_ord, payer_type, min_services from (
  select 'B-' || p_brand as rule_id, p_partkey as rule_ord, p_type as payer_type, p_size as min_services,
         row_number() over (partition by p_brand order by p_partkey desc) as rn
  from part) where rn = 1""",
)
def q_rules_last_wins(spark, sf_dir):
    part = Tables(spark, sf_dir).part
    rules = part.select(
        F.concat(F.lit("B-"), F.col("p_brand")).alias("rule_id"),
        F.col("p_partkey").alias("rule_ord"),
        F.col("p_type").alias("payer_type"),
        F.col("p_size").alias("min_services"),
    )
    return D.index_last(rules).select("rule_id", "rule_ord", "payer_type", "min_services")


#: Objects that wrap a rule's innermost params.
DEPTH = 8
_OPEN, _CLOSE = "".join(f'{{"level{i}":' for i in range(1, DEPTH)), "}" * (DEPTH - 1)
_INNER_PATH = "root['params']" + "".join(f"['level{i}']" for i in range(1, DEPTH))


def _nested(inner, outer):
    return F.concat(F.lit('{"top":'), outer, F.lit(f',"deep":{_OPEN}'), inner, F.lit(f"{_CLOSE}}}"))


def fx_nested_rules(part: DataFrame, candidate: bool) -> DataFrame:
    """Rules whose params are eight objects deep; what the candidate changes depends on the part key modulo 8."""
    k = F.col("p_partkey")
    size, brand = F.col("p_size").cast("string"), F.col("p_brand")
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    same = text('{"list":[1,["', brand, '",{"n":[', size, ',0]}]],"n":', size, "}")
    inner, outer = same, text('["', brand, '",2]')
    if candidate:
        inner = (
            F.when(k % 8 == 0, text('{"n":', size, ',"list":[[{"n":[0,', size, ',0]},"', brand, '"],1]}'))  # order and repetition only
            .when(k % 8 == 1, text('{"list":[1,["', brand, '",{"n":[', size, ',0]}]],"n":', (F.col("p_size") + 1).cast("string"), "}"))
            .when(k % 8 == 2, text('{"list":[1,["', brand, '",{"n":[', size, ',9]}]],"n":', size, "}"))
            .when(k % 8 == 3, text('{"list":[1,["', brand, '",{"n":[', size, ',0]}]],"n":"', size, '"}'))
            .when(k % 8 == 4, text('{"list":[1,["', brand, '",{"n":[', size, ',0]}]],"n":', size, ',"added":{"by":"', brand, '"}}'))
            .when(k % 8 == 5, text('{"n":', size, "}"))
            .otherwise(same)
        )
        outer = F.when(k % 8 == 6, text('[2,"', brand, '","x"]')).otherwise(text('[2,"', brand, '",2]'))
    params = _nested(inner, outer)
    if candidate:
        params = F.when(k % 8 != 7, params)
    return part.select(F.concat(F.lit("N-"), k.cast("string")).alias("rule_id"), k.alias("rule_ord"), F.lit("P").alias("payer_type"), params.alias("params_json"))


_OLD_LIST = "'[1,[\"' || p_brand || '\",{\"n\":[' || p_size || ',0]}]]'"


@register(
    "diff_params",
    covers=("D3",),
    oracle=f"""
with changes as (
  select p_partkey, p_brand, p_size, p_partkey % 8 as k, '{_INNER_PATH.replace("'", "''").replace("root[''params'']", "root[''params''][''deep'']")}' as inner_path from part)
select 'N-' || p_partkey as rule_id, change_type, path, old_value, new_value from (
  select p_partkey, 'values_changed' as change_type, inner_path || '[''n'']' as path, cast(p_size as varchar) as old_value, cast(p_size + 1 as varchar) as new_value from changes where k = 1
  union all
  select p_partkey, 'values_changed', inner_path || '[''list'']', {_OLD_LIST}, replace({_OLD_LIST}, ',0]', ',9]') from changes where k = 2
  union all
  select p_partkey, 'type_changes', inner_path || '[''n'']', cast(p_size as varchar), '"' || p_size || '"' from changes where k = 3
  union all
  select p_partkey, 'dictionary_item_added', inner_path || '[''added'']', null, '{{"by":"' || p_brand || '"}}' from changes where k = 4
  union all
  select p_partkey, 'dictionary_item_removed', inner_path || '[''list'']', {_OLD_LIST}, null from changes where k = 5
  union all
  select p_partkey, 'values_changed', 'root[''params''][''top'']', '["' || p_brand || '",2]', '[2,"' || p_brand || '","x"]' from changes where k = 6
  union all
  select p_partkey, 'dictionary_item_removed', 'root[''params'']',
         '{{"top":["' || p_brand || '",2],"deep":{_OPEN}' || '{{"list":' || {_OLD_LIST} || ',"n":' || p_size || '}}' || '{_CLOSE}}}', null from changes where k = 7)""",
)
def q_diff_params(spark, sf_dir):
    part = Tables(spark, sf_dir).part
    return D.diff_rules(fx_nested_rules(part, False), fx_nested_rules(part, True), ["payer_type"], params_col="params_json")
