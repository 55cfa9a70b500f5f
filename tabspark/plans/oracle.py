"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string runs on the pre-registered views (documents, labels, lineitem, ...).
Float results are rounded to 4 decimals on both sides; integer aggregates are
cast to BIGINT (DuckDB sums integers to HUGEINT).
"""

from __future__ import annotations

from tabspark.schema import FEATURES, INT_FEATURES

# Stand-in metric table F (documents ⋈ labels), DuckDB dialect.
F_CTE = r"""
f_t as (
  select d.doc_id as id, d.text as text, l.quality as quality, l.doc_id as lab,
         list_filter(string_split(replace(d.text, chr(10), ' '), ' '), lambda x: x <> '') as w
  from documents d join labels l on d.doc_id = l.doc_id),
f_m as (
  select id, quality, lab,
    cast((length(text)-length(replace(text,chr(10),''))) + 1 as double) as loc,
    cast((length(text)-length(replace(text,'.',''))) + 1 as double) as vg,
    cast((length(text)-length(replace(text,'?',''))) + 1 as double) as evg,
    cast((length(text)-length(replace(text,':',''))) + 1 as double) as ivg,
    cast((length(text)-length(replace(text,chr(10)||chr(10),''))) // 2 as bigint) as lOBlank,
    cast((length(text)-length(replace(text,chr(10)||'-',''))) // 2 as bigint) as lOComment,
    cast((length(text)-length(replace(text,'|',''))) as bigint) as locCodeAndComment,
    cast((case when instr(text,',')>0 then 1 else 0 end) + (case when instr(text,'.')>0 then 1 else 0 end)
       + (case when instr(text,';')>0 then 1 else 0 end) + (case when instr(text,':')>0 then 1 else 0 end)
       + (case when instr(text,'|')>0 then 1 else 0 end) + (case when instr(text,'-')>0 then 1 else 0 end) as double) as uniq_Op,
    cast(len(list_distinct(w)) as double) as uniq_Opnd,
    cast((length(text)-length(replace(text,',',''))) + (length(text)-length(replace(text,'.','')))
       + (length(text)-length(replace(text,';',''))) + (length(text)-length(replace(text,':','')))
       + (length(text)-length(replace(text,'|',''))) + (length(text)-length(replace(text,'-',''))) as double) as total_Op,
    cast(len(w) as double) as total_Opnd,
    cast((length(text)-length(replace(text,',',''))) as double) as branchCount
  from f_t),
f_h as (
  select *, total_Op + total_Opnd as n,
    (total_Op + total_Opnd) * log2(greatest(uniq_Op + uniq_Opnd, 2)) as v,
    greatest(uniq_Op, 1) / 2 * (greatest(total_Opnd, 1) / greatest(uniq_Opnd, 1)) as d
  from f_m),
F as (
  select id, loc, vg as "v(g)", evg as "ev(g)", ivg as "iv(g)", n, v, 1 / d as l, d, v / d as i,
    d * v as e, v / 3000 as b, d * v / 18 as t,
    cast(loc as bigint) - lOBlank - lOComment as lOCode, lOComment, lOBlank, locCodeAndComment,
    uniq_Op, uniq_Opnd, total_Op, total_Opnd, branchCount,
    case when quality = 0 then 'TRUE' when lab is not null then 'FALSE' end as defects
  from f_h)
"""


def q(name: str) -> str:
    """Quote an identifier for DuckDB."""
    return '"' + name.replace('"', '""') + '"'


def with_f(body: str, *more_ctes: str) -> str:
    ctes = [F_CTE.strip()] + [c.strip() for c in more_ctes]
    return "with " + ",\n".join(ctes) + "\n" + body


def fixture_sql() -> str:
    cols = ", ".join(["id"] + [q(c) for c in FEATURES] + ["defects"])
    return with_f(f"select {cols} from F")


# ------------------------------------------------------------------ helpers
LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]

LI_CTE = """
LI as (
  select l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber,
         case when l_returnflag = 'R' then 'TRUE' else 'FALSE' end as defects,
         case when l_returnflag = 'R' then 1 else 0 end as label
  from lineitem)
"""

LF_CTE = """
LF as (
  select *, case when defects in ('TRUE','true','True') then 1
                 when defects in ('FALSE','false','False') then 0 end as label
  from F)
"""


def r4(expr: str, digits: int = 4) -> str:
    """Same two-step display rounding as ``tabspark.functions.numeric.round4``."""
    return f"(round(round(cast({expr} as double), 10), {digits}) + 0.0)"


def long_cte(name: str, src: str, cols: list[str], keep: list[str]) -> str:
    on = ", ".join(q(c) for c in cols)
    sel = ", ".join([*(q(k) for k in keep), *(f"cast({q(c)} as double) as {q(c)}" for c in cols)])
    return f"{name} as (unpivot (select {sel} from {src}) on {on} into name feature value value)"


def _f_long(keep=("id", "defects")) -> str:
    return long_cte("long_f", "F", FEATURES, list(keep))


def _li_long(keep=("defects",)) -> str:
    return long_cte("long_li", "LI", LINEITEM_FEATURES, list(keep))


def _describe(long_name: str) -> str:
    return f"""select feature, count(value) as count, {r4('avg(value)')} as mean, {r4('stddev_samp(value)')} as std,
  {r4('min(value)')} as min, {r4('quantile_cont(value, 0.25)')} as q25, {r4('quantile_cont(value, 0.5)')} as q50,
  {r4('quantile_cont(value, 0.75)')} as q75, {r4('max(value)')} as max
from {long_name} group by feature"""


def _corr(src_long: str) -> str:
    return f"""select a.feature as feature_a, b.feature as feature_b,
  {r4('covar_pop(a.value, b.value) / nullif(stddev_pop(a.value) * stddev_pop(b.value), 0)')} as corr
from {src_long} a join {src_long} b on a.rid = b.rid group by a.feature, b.feature"""


def _outliers(long_name: str, src: str) -> str:
    return f"""select feature, outlier_count, {r4('outlier_count * 100.0::double / (select count(*) from ' + src + ')')} as outlier_pct,
  {r4('mn')} as min, {r4('mx')} as max, {r4('lo')} as lower_bound, {r4('hi')} as upper_bound
from (select l.feature, count(*) filter (where l.value < b.lo or l.value > b.hi) as outlier_count,
             min(l.value) as mn, max(l.value) as mx, any_value(b.lo) as lo, any_value(b.hi) as hi
      from {long_name} l join bounds b using (feature) group by l.feature)
where outlier_count > 0"""


def _bounds(long_name: str, keys=("feature",)) -> str:
    k = ", ".join(keys)
    return f"""bounds as (
  select {k}, q1, q3, q2, q1 - 1.5::double * (q3 - q1) as lo, q3 + 1.5::double * (q3 - q1) as hi from (
    select {k}, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as q2,
           quantile_cont(value, 0.75) as q3 from {long_name} group by {k}))"""


def _box(long_name: str, keys=("feature",), where: str = "true") -> str:
    k = ", ".join(f"l.{x}" for x in keys)
    return f"""select {k}, {r4('any_value(b.q1)')} as q1, {r4('any_value(b.q2)')} as median, {r4('any_value(b.q3)')} as q3,
  {r4('min(l.value) filter (where l.value >= b.lo and l.value <= b.hi)')} as whisker_lo,
  {r4('max(l.value) filter (where l.value >= b.lo and l.value <= b.hi)')} as whisker_hi,
  cast(count(*) filter (where not (l.value >= b.lo and l.value <= b.hi)) as bigint) as n_fliers
from {long_name} l join bounds b using ({', '.join(keys)}) where {where} group by {k}"""


TYPE_MAP = """case column_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'DOUBLE' then 'double'
  when 'VARCHAR' then 'string' when 'TIMESTAMP' then 'timestamp_ntz' when 'BOOLEAN' then 'boolean'
  when 'FLOAT' then 'float' when 'DATE' then 'date' else lower(column_type) end"""


def _missing_branches(with_position: bool = False) -> str:
    cols = [("id", False)] + [(c, c not in INT_FEATURES) for c in FEATURES] + [("defects", False)]
    parts = []
    for c, is_float in cols:
        cond = f"{q(c)} is null" + (f" or isnan({q(c)})" if is_float else "")
        pos = f"{len(parts) + 1} as position, " if with_position else ""
        parts.append(f"select {pos}'{c}' as column_name, cast(count(*) filter (where {cond}) as bigint) as missing, "
                     f"{r4(f'count(*) filter (where {cond}) * 100.0::double / nullif(count(*), 0)')} as missing_pct from F")
    return "\nunion all\n".join(parts)


def profile_sql() -> dict[str, str]:
    feats_sql = ", ".join(q(c) for c in FEATURES)
    lf_long = long_cte("long_lf", "(select row_number() over () as rid, * from LF)", FEATURES + ["label"], ["rid"])
    li_long_rid = long_cte("long_lir", "(select row_number() over () as rid, * from LI)",
                           LINEITEM_FEATURES + ["label"], ["rid"])
    top_var = ("topv as (select feature from long_f group by feature "
               "order by var_samp(value) desc nulls last, feature limit 5)")
    f_out = "fo as (" + _outliers("long_f", "F").replace("\n", " ") + ")"
    return {
        "shape": with_f(f"select cast(count(*) as bigint) as n_rows, cast({len(FEATURES) + 2} as bigint) as n_cols from F"),
        "table_info": f"""select cast(row_number() over () as int) as position, column_name, {TYPE_MAP} as data_type,
  (select cast(count(*) as bigint) from lineitem) as n_rows from (describe select * from lineitem)""",
        "dtype_counts": f"""select {TYPE_MAP} as data_type, cast(count(*) as bigint) as n_columns
from (describe select * from lineitem) group by 1""",
        "variance_profile": "with " + LI_CTE.strip() + ",\n" + _li_long() + f"""
select feature, {r4('var_samp(value)')} as variance from long_li group by feature""",
        "missing_profile": with_f(_missing_branches()),
        "describe_numeric": "with " + LI_CTE.strip() + ",\n" + _li_long() + "\n" + _describe("long_li"),
        "describe_metrics": with_f(_describe("long_f"), _f_long()),
        "target_distribution": with_f(f"""select defects, cast(n as bigint) as n,
  {r4('case when defects is null then null else n * 100.0::double / sum(case when defects is not null then n else 0 end) over () end')} as share_pct,
  {r4('n * 100.0::double / sum(n) over ()')} as share_all_pct
from (select cast(defects as varchar) as defects, count(*) as n from F group by 1)"""),
        "top_variance": with_f(f"""select feature, {r4('var_samp(value)')} as variance from long_f group by feature
order by var_samp(value) desc nulls last, feature limit 10""", _f_long()),
        "correlation_matrix": with_f(_corr("long_lf"), LF_CTE, lf_long),
        "target_correlation": with_f("select feature_a as feature, corr from (" + _corr("long_lf") +
                                     ") where feature_b = 'label' and feature_a <> 'label'", LF_CTE, lf_long),
        "top_correlations": with_f("select feature_a as feature, abs(corr) as abs_corr from (" + _corr("long_lf") +
                                   ") where feature_b = 'label' and feature_a <> 'label' and corr is not null "
                                   "order by abs(corr) desc, feature_a limit 10", LF_CTE, lf_long),
        "lineitem_correlation": "with " + LI_CTE.strip() + ",\n" + li_long_rid + "\n" + _corr("long_lir"),
        "sparse_correlation": f"""with e as (select row_number() over () as rid, value, event_id::double as event_id, case when user_id % 3 = 0 then value * value end as part,
    case when user_id % 3 = 1 then user_id::double when user_id % 3 = 0 then 0.1::double end as flat, null::double as none from events),
  cols as (select unnest(['value', 'event_id', 'part', 'flat', 'none']) as c),
  long as (unpivot (select rid, value, event_id, part, flat from e) on value, event_id, part, flat into name c value v),
  pairs as (select a.c as feature_a, b.c as feature_b, covar_pop(a.v, b.v) as cov, stddev_pop(a.v) as sa, stddev_pop(b.v) as sb,
    min(a.v) < max(a.v) and min(b.v) < max(b.v) as moves from long a join long b using (rid) group by 1, 2)
select x.c as feature_a, y.c as feature_b, {r4('case when moves then cov / (sa * sb) end')} as corr
from cols x cross join cols y left join pairs on feature_a = x.c and feature_b = y.c""",
        "outlier_profile": with_f(_outliers("long_f", "F"), _f_long(), _bounds("long_f")),
        "lineitem_outliers": "with " + LI_CTE.strip() + ",\n" + _li_long() + ",\n" + _bounds("long_li") + "\n"
                             + _outliers("long_li", "LI"),
        "events_outliers": "with ev as (select 'value' as feature, value from events),\n" + _bounds("ev") + "\n" + _outliers("ev", "ev"),
        "lineitem_deciles": "with " + LI_CTE.strip() + ",\n" + _li_long() + f"""
select feature, defects, n, p, {r4('list_extract(v, i)')} as value from (
  select feature, defects, count(value) as n, quantile_cont(value, [{', '.join(f'{i / 10}' for i in range(1, 10))}]) as v from long_li group by all),
  (select unnest(range(1, 10)) as i, unnest([{', '.join(f'{i / 10}::double' for i in range(1, 10))}]) as p)""",
        "top_outliers": with_f("select feature, outlier_pct from fo order by outlier_pct desc, feature limit 5",
                               _f_long(), _bounds("long_f"), f_out),
        "outlier_rows": with_f(f"""select l.id, l.feature, {r4('l.value')} as value from long_f l join bounds b using (feature)
where l.value < b.lo or l.value > b.hi""", _f_long(), _bounds("long_f")),
        "histogram": """with mm as (select min(l_extendedprice) as mn, max(l_extendedprice) as mx from lineitem),
c as (select cast(least(floor((l_extendedprice - mn) / (mx - mn) * 30), 29) as int) as bin, count(*) as n
      from lineitem, mm group by 1),
g as (select cast(range as int) as bin from range(30))
select g.bin, round(round(mn + g.bin * ((mx - mn) / 30), 10), 4) + 0.0 as bin_lo, round(round(mn + (g.bin + 1) * ((mx - mn) / 30), 10), 4) + 0.0 as bin_hi,
  cast(coalesce(c.n, 0) as bigint) as n
from g left join c on g.bin = c.bin, mm""",
        "kde_curve": """with s as (select count(*) as n, stddev_samp(l_extendedprice) as sd, min(l_extendedprice) as mn,
    max(l_extendedprice) as mx from lineitem),
p as (select cast(range as int) as point, mn + (mx - mn) * range / 199 as x, sd * pow(n, -0.2) as h, n, mn, mx from range(200), s)
select p.point, round(round(p.x, 10), 4) + 0.0 as x,
  round(round(sum(exp(-0.5 * pow((p.x - l.l_extendedprice) / p.h, 2))) * (1.0 / (p.n * p.h * sqrt(2 * pi())) * p.n * ((p.mx - p.mn) / 30)), 10), 4) + 0.0 as density_count
from p, lineitem l group by p.point, p.x, p.h, p.n, p.mn, p.mx""",
        "feature_distributions": with_f(f"""select g.feature, cast(g.bin as int) as bin,
  {r4('s.mn + g.bin * (s.sp / 30)')} as bin_lo, {r4('s.mn + (g.bin + 1) * (s.sp / 30)')} as bin_hi,
  cast(coalesce(c.n, 0) as bigint) as n, {r4('s.mean')} as mean, {r4('s.std')} as std
from (select feature, range as bin from topv10, range(30)) g join st s using (feature)
left join (select l.feature, cast(case when s.sp > 0 then least(floor((l.value - s.mn) / s.sp * 30), 29) else 0 end as int) as bin,
                  count(*) as n from long_f l join st s using (feature) group by 1, 2) c using (feature, bin)""",
            _f_long(), "topv10 as (select feature from long_f group by feature order by var_samp(value) desc nulls last, feature limit 10)",
            "st as (select feature, min(value) as mn, max(value) - min(value) as sp, avg(value) as mean, stddev_samp(value) as std, count(value) as n from long_f group by feature)"),
        "feature_kde": with_f(f"""select p.feature, p.point, {r4('p.x')} as x,
  {r4('sum(exp(-0.5 * pow((p.x - l.value) / p.h, 2))) * (1.0 / (p.n * p.h * sqrt(2 * pi())) * p.n * ((p.mx - p.mn) / 30))')} as density_count
from (select s.feature, cast(r.range as int) as point, s.mn + (s.mx - s.mn) * r.range / 199 as x, s.sd * pow(s.n, -0.2) as h,
             s.n, s.mn, s.mx from st s, range(200) r where s.feature in (select feature from topv10) and s.sd > 0) p
join long_f l using (feature) group by p.feature, p.point, p.x, p.h, p.n, p.mn, p.mx""",
            _f_long(), "topv10 as (select feature from long_f group by feature order by var_samp(value) desc nulls last, feature limit 10)",
            "st as (select feature, min(value) as mn, max(value) as mx, stddev_samp(value) as sd, count(value) as n from long_f group by feature)"),
        "box_stats_by_target": with_f(_box("long_f", ("feature", "defects"), "l.feature in (select feature from topv)"),
                                      _f_long(), top_var, _bounds("long_f", ("feature", "defects"))),
        "box_stats_outliers": with_f(_box("long_f", ("feature",),
                                          "l.feature in (select feature from fo order by outlier_pct desc, feature limit 6)"),
                                     _f_long(), _bounds("long_f"), f_out),
        "lineitem_box_stats": "with " + LI_CTE.strip() + ",\n" + _li_long() + ",\n" +
                              _bounds("long_li", ("feature", "defects")) + "\n" + _box("long_li", ("feature", "defects")),
    }


def split_cte(src: str, label: str, key: str, seed: int = 42, test: float = 0.2, val: float = 0.1) -> str:
    """SQL form of the stratified split: quotas by largest remainder, md5 order."""
    return f"""
sp_cc as (select {label} as c, count(*) as cnt from {src} where {label} is not null group by 1),
sp_n as (select sum(cnt) as n, ceil({test}::double * sum(cnt)) as n_test from sp_cc),
sp_r1 as (select c, cnt, cnt / n * (n - n_test) as cont, floor(cnt / n * (n - n_test)) as fl, n - n_test as n_rest
          from sp_cc, sp_n),
sp_q1 as (select c, cnt, n_rest, fl + case when row_number() over (order by cont - fl desc, c)
                 <= n_rest - sum(fl) over () then 1 else 0 end as rest_q from sp_r1),
sp_v as (select n_rest, n_rest - ceil({val}::double / (1 - {test}::double) * n_rest) as n_train from (select distinct n_rest from sp_q1)),
sp_r2 as (select c, cnt, rest_q, rest_q / n_rest * n_train as cont, floor(rest_q / n_rest * n_train) as fl, n_train
          from sp_q1 join sp_v using (n_rest)),
sp_q as (select c, cnt - rest_q as test_q,
                rest_q - (fl + case when row_number() over (order by cont - fl desc, c)
                          <= n_train - sum(fl) over () then 1 else 0 end) as val_q from sp_r2),
sp as (select s.*, case when rn < q.test_q then 'test' when rn < q.test_q + q.val_q then 'val' else 'train' end as split
       from (select *, row_number() over (partition by {label} order by md5('{seed}:' || cast({key} as varchar)), {key}) - 1 as rn
             from {src} where {label} is not null) s join sp_q q on s.{label} = q.c)
"""


def place_macro(epochs: int, seed: int = 42) -> str:
    """CTEs ``ks`` (epoch, keys) and the lambda text of one pass: the shuffle of ``operators.minibatch`` in DuckDB, over
    columns n, a, b of a row."""
    from tabspark.operators.minibatch import MIXER, PRIME, round_keys

    def mix(v):
        return f"(((({v} + k) % {PRIME}) * (({v} + k) % {PRIME}) % {PRIME} * {MIXER} + k) % {PRIME})"
    left = f"((p // b + {mix('(p % b)')}) % a)"
    once = lambda v: f"list_reduce(ks, lambda p, k: {left} * b + (p % b + {mix(left)}) % b, CAST({v} AS BIGINT))"
    keys = " union all ".join(f"select {e} as epoch, [{', '.join(f'{k}::bigint' for k in round_keys(seed, e))}] as ks" for e in range(epochs))
    place = f"list_reduce(range(64), lambda y, i: case when y < n then y else {once('y')} end, {once('r')})"
    return f"""ks as ({keys}),
pl as (select epoch, id, n, {place} as place from (select id, row_number() over (order by id) - 1 as r from tr) x, ks,
  (select n, a, (n + a - 1) // a as b from (select count(*) as n, cast(floor(sqrt(count(*) - 1)) as bigint) + 1 as a from tr)) z)"""


def split_sql() -> dict[str, str]:
    feats = ", ".join(q(c) for c in FEATURES)
    prep = f"P as (select id, {feats}, label from LF)"
    sp = split_cte("P", "label", "id")
    stats = ", ".join(f"avg({q(c)}) as {q('m_' + c)}, coalesce(nullif(stddev_pop({q(c)}), 0), 1) as {q('s_' + c)}"
                      for c in FEATURES)
    scaled = ", ".join(f"{r4(f'({q(c)} - {q(chr(109) + chr(95) + c)}) / {q(chr(115) + chr(95) + c)}')} as {q(c)}"
                       for c in FEATURES)
    fit_rows = "\nunion all\n".join(
        f"select '{c}' as feature, {r4(q('m_' + c))} as mean, {r4(q('s_' + c))} as scale from st" for c in FEATURES)
    return {
        "normalize_target": with_f("select id, label from LF", LF_CTE),
        "target_audit": """select coalesce(bad_value, '<null>') as bad_value, cast(count(*) as bigint) as n_rows
from (select cast(toxic as varchar) as bad_value from labels) where bad_value is null or bad_value not in
  ('TRUE','true','True','FALSE','false','False') group by bad_value""",
        "prepare": with_f(f"select id, {', '.join(f'cast({q(c)} as double) as {q(c)}' for c in FEATURES)}, label from LF",
                          LF_CTE),
        "stratified_split": with_f("select id, label, split from sp", LF_CTE, prep, sp),
        "minibatch_plan": with_f("""select epoch, cast(place // 32 as bigint) as batch, cast(place as bigint) as place, id from pl where place // 32 < n // 32""",
                                 LF_CTE, prep, sp, "tr as (select id from sp where split = 'train')", place_macro(3)),
        # epochs 0 to 10 of the schedule: a cosine of 10 epochs, then the first of the restart
        "mlp_fit_facts": with_f(f"""select cast(e as int) as epoch, n // 32 * 32 as rows_seen, n // 32 as batches,
  {r4('1000 * (1e-6 + (1e-3 - 1e-6) * (1 + cos(pi() * (e % 10) / 10)) / 2)')} as lr_1000, true as replayed
from (select unnest(range(11)) as e), (select count(*) as n from sp where split = 'train')""", LF_CTE, prep, sp),
        "split_counts": with_f("select split, label, cast(count(*) as bigint) as n from sp group by 1, 2",
                               LF_CTE, prep, sp),
        "orders_split_counts": "with " + split_cte("orders", "o_orderstatus", "o_orderkey").strip() + """
select split, o_orderstatus, cast(count(*) as bigint) as n, cast(sum(o_orderkey) as bigint) as key_sum
from sp group by 1, 2""",
        "split_metadata": with_f(f"""select split, cast(count(*) as bigint) as n_samples, {len(FEATURES)} as n_features,
  'StandardScaler' as scaler, 0.2::double as test_size, 0.1::double as val_size from sp group by split""",
                                 LF_CTE, prep, sp),
        "fit_scaler": with_f(fit_rows, LF_CTE, prep, sp, f"st as (select {stats} from sp where split = 'train')"),
        "scale_features": with_f(f"select id, split, label, {scaled} from sp, st", LF_CTE, prep, sp,
                                 f"st as (select {stats} from sp where split = 'train')"),
    }


def metrics_sql() -> dict[str, str]:
    scored = "SC as (select id, label, 1 - l as defect_probability, cast(1 - l > 0.5 as int) as prediction from LF)"
    conf = """select cast(sum(case when label = 1 and prediction = 1 then 1 else 0 end) as bigint) as tp,
  cast(sum(case when label = 0 and prediction = 1 then 1 else 0 end) as bigint) as fp,
  cast(sum(case when label = 0 and prediction = 0 then 1 else 0 end) as bigint) as tn,
  cast(sum(case when label = 1 and prediction = 0 then 1 else 0 end) as bigint) as fn from SC"""

    def zd(a, b):
        return f"case when ({b}) = 0 then 0.0 else ({a})::double / ({b}) end"

    auc = lambda src, s: f"""g as (select {s} as s, sum(case when label = 1 then 1 else 0 end)::double as pos,
    sum(case when label = 1 then 0 else 1 end)::double as neg from {src} where label is not null and {s} is not null group by 1),
c as (select *, coalesce(sum(neg) over (order by s rows between unbounded preceding and 1 preceding), 0) as below from g)
|select {r4('case when sum(pos) > 0 and sum(neg) > 0 then sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) else 0.0 end')} as roc_auc,
  cast(coalesce(sum(pos), 0) as bigint) as n_pos, cast(coalesce(sum(neg), 0) as bigint) as n_neg from c"""  # noqa: E731
    z = "list_transform(range(10), lambda k: list_sum(list_filter(embedding, lambda x, i: (i - 1) % 10 = k)::double[]))"
    emb = f"E as (select {z} as logits, label from embeddings)"
    cw = """cw as (select label, cnt, case when min(cnt) over () = 0 then 1.0
                 else (sum(cnt) over ())::double / (10 * cnt) end as w
      from (select r.range::int as label, count(e.label) as cnt from range(10) r left join E e on e.label = r.range group by 1))"""
    lse = "(list_max(logits) + ln(list_sum(list_transform(logits, lambda x: exp(x::double - list_max(logits))))))"
    hist = "Hh as (select user_id as run_id, row_number() over (partition by user_id order by ts, event_id) as epoch, value from events)"
    imp = """Hi as (select *, max(case when improved then epoch end) over (partition by run_id order by epoch rows between unbounded preceding and current row) as last_improved
  from (select *, (max(value) over (partition by run_id order by epoch rows between unbounded preceding and 1 preceding)) is null
               or value > max(value) over (partition by run_id order by epoch rows between unbounded preceding and 1 preceding) as improved from Hh))"""
    return {
        "softmax": f"""select vec_id, cast(list_position(embedding, list_max(embedding)) - 1 as int) as argmax,
  {r4('list_max(p)')} as confidence, {r4('p[1]')} as p_first, {r4('list_sum(p)')} as prob_sum
from (select vec_id, embedding, list_transform(ex, lambda x: x / list_sum(ex)) as p
      from (select vec_id, embedding, list_transform(embedding, lambda x: exp(x::double - list_max(embedding))) as ex from embeddings))""",
        "argmax": f"""with {emb} select predicted, cast(count(*) as bigint) as n, cast(sum(case when predicted = label then 1 else 0 end) as bigint) as n_correct
from (select cast(list_position(logits, list_max(logits)) - 1 as int) as predicted, label from E) group by 1""",
        "class_counts": """select r.range::int as label, cast(count(e.label) as bigint) as n
from range(10) r left join embeddings e on e.label = r.range group by 1""",
        "class_weights": with_f(f"""select label, n, {r4('case when min(n) over () = 0 then 1.0 else (sum(n) over ())::double / (2 * n) end')} as weight
from (select r.range::int as label, cast(count(t.label) as bigint) as n from range(2) r
      left join (select label from sp where split = 'train') t on t.label = r.range group by 1)""",
                                LF_CTE, f"P as (select id, label from LF)", split_cte("P", "label", "id")),
        "confusion": with_f(conf, LF_CTE, scored),
        "binary_metrics": with_f(f"""select {r4(zd('tp + tn', 'tp + fp + tn + fn'))} as accuracy, {r4(zd('tp', 'tp + fp'))} as precision,
  {r4(zd('tp', 'tp + fn'))} as recall, {r4(zd('2 * tp', '2 * tp + fp + fn'))} as f1 from ({conf})""", LF_CTE, scored),
        "roc_auc": with_f(auc("SC", "defect_probability").split("|")[1], LF_CTE, scored,
                          auc("SC", "defect_probability").split("|")[0]),
        "lineitem_roc_auc": "with " + LI_CTE.strip() + ",\n" + auc("LI", "l_extendedprice").replace("|", ""),
        "prediction_summary": with_f(f"""select cast(count(*) as bigint) as n_rows,
  cast(sum(case when prediction = 1 then 1 else 0 end) as bigint) as n_defects, {r4('avg(defect_probability)')} as mean_probability from SC""",
                                     LF_CTE, scored),
        "focal_loss": f"""with {emb}, {cw}
select {r4(f'avg(cw.w * pow(1 - exp(logits[E.label + 1] - {lse}), 2) * -(logits[E.label + 1] - {lse}))')} as loss
from E join cw on E.label = cw.label""",
        "weighted_ce": f"""with {emb}, {cw}, W as (select list(w order by label) as wl from cw)
select {r4(f'sum(0.9 * wl[E.label + 1] * -(logits[E.label + 1] - {lse}) + 0.1 / len(logits) * -list_sum(list_transform(list_zip(logits, wl), lambda e: e[2] * (e[1]::double - {lse})))) / sum(wl[E.label + 1])')} as loss
from E, W""",
        # the rule replayed over the history says so itself; trials and first rates are the study's grid
        "mlp_tune_facts": """select * from (values (0, '{"learning_rate": 0.001}', 1.0::double, true),
  (1, '{"hidden_sizes": [32, 16], "learning_rate": 0.01}', 10.0::double, true), (2, '{"learning_rate": 1e-05}', 0.01::double, true),
  (3, '{"learning_rate": 0.005}', 5.0::double, true)) t(trial, params, lr_1000, replayed)""",
        "latency_summary": f"""select cast(count(value) as bigint) as total_requests, cast(count(value) as bigint) as total_samples, 1 as batch_size,
  {r4('avg(value)')} as avg_latency, {r4('quantile_cont(value, 0.5)')} as p50_latency, {r4('quantile_cont(value, 0.95)')} as p95_latency,
  {r4('quantile_cont(value, 0.99)')} as p99_latency, {r4('min(value)')} as min_latency, {r4('max(value)')} as max_latency,
  {r4('count(value) / sum(value)')} as throughput from events""",
        "best_so_far": f"""with {hist} select run_id, epoch, value,
  max(value) over (partition by run_id order by epoch rows between unbounded preceding and current row) as best_so_far from Hh""",
        "early_stop": f"""with {hist}, {imp}
select run_id, coalesce(min(case when epoch - last_improved >= 10 then epoch end), max(epoch)) as stop_epoch,
  min(case when epoch - last_improved >= 10 then epoch end) is not null as early_stopped, max(epoch) as n_epochs
from Hi group by run_id""",
        "best_epoch": f"""with {hist} select run_id, epoch as best_epoch, value as best_value from
  (select *, row_number() over (partition by run_id order by value desc, epoch) as rk from Hh) where rk = 1""",
        "prune_trials": f"""with {hist}, B as (select *, max(value) over (partition by run_id order by epoch rows between unbounded preceding and current row) as bsf from Hh),
M as (select epoch, quantile_cont(value, 0.5) as med from Hh group by epoch)
select run_id, min(case when bsf < med and epoch > 0 then epoch end) is not null as pruned,
  coalesce(min(case when bsf < med and epoch > 0 then epoch end), max(epoch)) as pruned_at from B join M using (epoch) group by run_id""",
    }


def _lit(x: float) -> str:
    s = repr(float(x))
    if s in ("inf", "-inf", "nan"):
        return f"'{s}'::double"
    return s if ("e" in s or "E" in s) else s + "e0"


def mlp_forward_sql(model, src: str, keep: list[str], inputs: list[str]) -> list[str]:
    """CTEs computing the eval-mode forward pass of a fixed-weight model in SQL.
    The last CTE is ``mlp_out`` with keep columns, logit_j, p_j, prediction."""
    import math
    from tabspark.operators.mlp_math import BN_EPS
    p, w = model.params, model.weights
    kc = ", ".join(keep)
    ctes = [f"mlp_l0 as (select {kc}, " + ", ".join(
        f"cast(cast({e} as float) as double) as a{i}" for i, e in enumerate(inputs)) + f" from {src})"]
    width = len(inputs)
    for li, h in enumerate(p.hidden_sizes):
        W, b = w[f"W{li}"], w[f"b{li}"]
        cols = []
        for j in range(h):
            z = " + ".join(f"a{i} * {_lit(W[i, j])}" for i in range(width)) + f" + {_lit(b[j])}"
            if p.use_batchnorm:
                inv = 1.0 / math.sqrt(w[f"rv{li}"][j] + BN_EPS)
                y = f"(({z}) - {_lit(w[f'rm{li}'][j])}) * {_lit(inv)} * {_lit(w[f'g{li}'][j])} + {_lit(w[f'be{li}'][j])}"
            else:
                raise NotImplementedError("SQL oracle covers the batch-norm layout")
            cols.append(f"greatest({y}, 0.0) as a{j}")
        ctes.append(f"mlp_l{li + 1} as (select {kc}, " + ", ".join(cols) + f" from mlp_l{li})")
        width = h
    last = f"mlp_l{len(p.hidden_sizes)}"
    Wo, bo = w["Wo"], w["bo"]
    outs = [" + ".join(f"a{i} * {_lit(Wo[i, c])}" for i in range(width)) + f" + {_lit(bo[c])} as z{c}"
            for c in range(p.num_classes)]
    ctes.append(f"mlp_z as (select {kc}, " + ", ".join(outs) + f" from {last})")
    ctes.append(f"""mlp_out as (select {kc}, z0 as logit_0, z1 as logit_1,
  exp(z0 - greatest(z0, z1)) / (exp(z0 - greatest(z0, z1)) + exp(z1 - greatest(z0, z1))) as p0,
  exp(z1 - greatest(z0, z1)) / (exp(z0 - greatest(z0, z1)) + exp(z1 - greatest(z0, z1))) as p1 from mlp_z)""")
    return ctes


def mlp_sql() -> dict[str, str]:
    from tabspark.operators.mlp import fixed_model
    model = fixed_model(FEATURES)
    feats = ", ".join(q(c) for c in FEATURES)
    prep = f"P as (select id, {feats}, label from LF)"
    sp = split_cte("P", "label", "id")
    stats = ", ".join(f"avg({q(c)}) as {q('m_' + c)}, coalesce(nullif(stddev_pop({q(c)}), 0), 1) as {q('s_' + c)}"
                      for c in FEATURES)
    st = f"st as (select {stats} from sp where split = 'train')"
    scaled_inputs = [f"({q(c)} - {q('m_' + c)}) / {q('s_' + c)}" for c in FEATURES]
    raw = mlp_forward_sql(model, "P", ["id"], [q(c) for c in FEATURES])
    piped = mlp_forward_sql(model, "(select * from sp, st) x", ["id", "label", "split"], scaled_inputs)
    view = f"""select id, cast(case when p1 > p0 then 1 else 0 end as int) as prediction, p1 > p0 as is_defect,
  {r4('p1')} as defect_probability, {r4('greatest(p0, p1)')} as confidence from mlp_out"""
    test_view = view + " where split = 'test'"
    sc = f"""SC as (select label, case when p1 > p0 then 1 else 0 end as prediction, p1 as s from mlp_out where split = 'test')"""
    return {
        "mlp_score": with_f(view, LF_CTE, prep, *raw),
        "mlp_logits": with_f(f"select id, {r4('logit_0')} as logit_0, {r4('logit_1')} as logit_1 from mlp_out",
                             LF_CTE, prep, *raw),
        "preprocess_score": with_f(test_view, LF_CTE, prep, sp, st, *piped),
        "evaluate": with_f(f"""select {r4('case when count(*) = 0 then 0.0 else sum(case when label = prediction then 1 else 0 end)::double / count(*) end')} as accuracy,
  {r4('case when sum(prediction) = 0 then 0.0 else sum(case when label = 1 and prediction = 1 then 1 else 0 end)::double / sum(prediction) end')} as precision,
  {r4('case when sum(label) = 0 then 0.0 else sum(case when label = 1 and prediction = 1 then 1 else 0 end)::double / sum(label) end')} as recall,
  {r4('case when sum(label) + sum(prediction) = 0 then 0.0 else 2.0 * sum(case when label = 1 and prediction = 1 then 1 else 0 end) / (sum(label) + sum(prediction)) end')} as f1,
  (select {r4('case when sum(pos) > 0 and sum(neg) > 0 then sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) else 0.0 end')} from c) as roc_auc
from SC""", LF_CTE, prep, sp, st, *piped, sc,
            """g as (select s, sum(case when label = 1 then 1 else 0 end)::double as pos, sum(case when label = 1 then 0 else 1 end)::double as neg from SC group by s)""",
            """c as (select *, coalesce(sum(neg) over (order by s rows between unbounded preceding and 1 preceding), 0) as below from g)"""),
        "score_batches": with_f("""select cast(case split when 'train' then 0 when 'val' then 1 else 2 end as int) as batch_id,
  cast(count(*) as bigint) as n_rows, cast(sum(case when p1 > p0 then 1 else 0 end) as bigint) as n_defects
from mlp_out group by 1""", LF_CTE, prep, sp, st, *piped),
        "sample_head": with_f(test_view + " order by id limit 5", LF_CTE, prep, sp, st, *piped),
        "mlp_prediction_summary": with_f(f"""select cast(count(*) as bigint) as n_rows,
  cast(sum(case when p1 > p0 then 1 else 0 end) as bigint) as n_defects, {r4('avg(p1)')} as mean_probability
from mlp_out where split = 'test'""", LF_CTE, prep, sp, st, *piped),
    }


def io_sql() -> dict[str, str]:
    feats = ", ".join(q(c) for c in FEATURES)
    rnd = ", ".join(f"{r4(q(c))} as {q(c)}" for c in FEATURES)
    prep = f"P as (select id, {feats}, label from LF)"
    sp = split_cte("P", "label", "id")
    from tabspark.operators.mlp import fixed_model
    raw = mlp_forward_sql(fixed_model(FEATURES), "P", ["id"], [q(c) for c in FEATURES])
    view = f"""select id, cast(case when p1 > p0 then 1 else 0 end as int) as prediction, p1 > p0 as is_defect,
  {r4('p1')} as defect_probability, {r4('greatest(p0, p1)')} as confidence from mlp_out"""
    aligned = ", ".join(f"{r4('0.0' if c in ('e', 't') else q(c))} as {q(c)}" for c in FEATURES)
    out_pct = "outlier_count * 100.0::double / (select count(*) from F)"
    return {
        "request_explode": with_f(f"select cast(floor(id / 4) as bigint) as request_id, id, {rnd} from F"),
        "request_inputs": with_f(f"""select cast(floor(id / 4) as bigint) as request_id,
  cast(row_number() over (partition by floor(id / 4) order by id) - 1 as int) as pos, true as width_ok, {rnd} from F"""),
        "mixed_requests": with_f(f"""select request_id, null::varchar as reason, {', '.join(q(c) for c in FEATURES)} from (
  select cast(floor(id / 4) as bigint) as request_id, {rnd} from F) join why using (request_id) where reason is null
union all select request_id, reason, {', '.join('null' for _ in FEATURES)} from why where reason is not null""",
                                 """why as (select r as request_id, case when r % 7 = 3 then 'malformed' when r % 11 = 5 then 'type' when r % 13 = 6 then 'width'
  when r % 17 = 8 then 'empty' end as reason from (select distinct cast(floor(id / 4) as bigint) as r from F))"""),
        "counted_write": """select status, cast(count(*) as bigint) as counted, cast(count(*) as bigint) as written, cast(sum(l_orderkey) as bigint) as id_sum
from (select l_orderkey, case when l_linenumber = 7 then 'corrupt' when l_returnflag in ('R', 'A') then 'kept' else 'unmapped' end as status from lineitem) group by 1""",
        "rejected_targets": """select l_returnflag as defects, cast(count(*) as bigint) as n_rows from lineitem
where l_returnflag not in ('R', 'A') group by 1""",
        "rejected_requests": """select doc_id, reason from (select doc_id, case n_chars % 5 when 1 then 'empty' when 2 then 'malformed'
  else case n_chars % 3 when 0 then 'width' end end as reason from documents) where reason is not null""",
        "align_features": with_f(f"select id, {aligned} from F"),
        "width_check": with_f(f"""select 'metrics' as source, true as width_ok, cast(count(*) as bigint) as n from F
union all select 'embeddings', len(embedding) = {len(FEATURES)}, cast(count(*) as bigint) from embeddings group by 2"""),
        "eda_report": with_f("""select cast(line as int) as line, section, key, case
    when section = 'outliers' then cast(round(round(pct, 10), 1) as varchar) || '%'
    when pct is null then cast(cnt as varchar)
    else cast(cnt as varchar) || ' (' || cast(round(round(pct, 10), 1) as varchar) || '%)' end as value
from base""", LF_CTE, _f_long(), _bounds("long_f"),
            "fo as (" + _outliers("long_f", "F").replace("\n", " ") + ")",
            "mp as (" + _missing_branches(with_position=True).replace("\n", " ") + ")",
            f"""base as (
  select 1 as line, 'shape' as section, 'rows' as key, (select count(*) from F) as cnt, null::double as pct
  union all select 2, 'shape', 'columns', {len(FEATURES) + 3}, null
  union all select 3 + c.range, 'target', 'class_' || c.range, count(LF.label),
         count(LF.label) * 100.0::double / (select count(*) from F) from range(2) c left join LF on LF.label = c.range group by c.range
  union all select 10 + row_number() over (order by position) - 1, 'missing', column_name, missing,
         missing * 100.0::double / (select count(*) from F) from mp where missing > 0
  union all select 10, 'missing', 'none', 0, null where not exists (select 1 from mp where missing > 0)
  union all (select 100 + row_number() over (order by outlier_pct desc, feature) - 1, 'outliers', feature, outlier_count,
         {out_pct} from fo order by outlier_pct desc, feature limit 5))"""),
        "csv_roundtrip": with_f(f"select id, defects, {rnd} from F"),
        "split_sink": with_f("""select label, cast(count(*) as bigint) as n, cast(sum(id) as bigint) as id_sum
from sp where split = 'test' group by label""", LF_CTE, prep, sp),
        "stream_score": with_f(view, LF_CTE, prep, *raw),
        "stream_requests": with_f(view, LF_CTE, prep, *raw),
    }


#: Queries that need no label, and so take F over every document.
OF_ALL_DOCUMENTS = ("missing_profile", "mlp_score", "mlp_logits", "stream_score", "stream_requests", "request_explode", "request_inputs",
                    "mixed_requests", "align_features", "csv_roundtrip")


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(profile_sql())
    out.update(split_sql())
    out.update(metrics_sql())
    out.update(mlp_sql())
    out.update(io_sql())
    for name in OF_ALL_DOCUMENTS:
        out[name] = out[name].replace("from documents d join labels l", "from documents d left join labels l")
    return out
