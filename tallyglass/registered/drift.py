"""Queries that compare each day with the previous available one."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyglass import adapters
from tallyglass.functions.tails import f_upper, student_t_two_sided
from tallyglass.operators import changepoint, cleaning, drift, normality, ranks, segmentation
from tallyglass.operators.profile import calendar
from tallyglass.registered.common import CALENDAR, CLEAN, present, r, unpivot_sql
from tallyglass.schema import NUMERIC_COLUMNS
from tallyglass.workspace import checked_broadcast, materialize

FEATURES = NUMERIC_COLUMNS
SERIES = ["tx_amount", "customer_id", "terminal_id", "tx_time_seconds"]
SERIES_PENALTY = 1.0
CATEGORICAL = ["tx_fraud", "tx_fraud_scenario"]


def _rows(spark, sf_dir):
    return cleaning.with_day(cleaning.clean(adapters.transactions(spark, sf_dir)))


def _compare(spark, sf_dir):
    return drift.compare_days(_rows(spark, sf_dir), FEATURES, categorical=CATEGORICAL)


def normality_jb(spark, sf_dir):
    table = drift.jarque_bera(drift.day_moments(_rows(spark, sf_dir), FEATURES))
    out = table.select("date", "feature", "n", "jb", "p_value", F.col("normal").cast("int").alias("normal"))
    return present(out, 4, doubles=("normal",))


def _calendar(rows):
    return checked_broadcast(calendar(rows), "calendar")


def _cells(spark, sf_dir, columns=FEATURES):
    rows = _rows(spark, sf_dir)
    return materialize(drift.pair_cells(rows, columns, _calendar(rows)), "pair-cells")


def _spread(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    return drift.spread_and_stability(cells, drift.rank_summary(cells))


def normality_sw(spark, sf_dir):
    table = normality.shapiro_wilk(_rows(spark, sf_dir), FEATURES, ["date"])
    return present(table.select("date", "feature", "n", "w", "note"))


def normality_sw_total(spark, sf_dir):
    """All values of a column as one sample."""
    table = normality.shapiro_wilk(_rows(spark, sf_dir), FEATURES, [])
    return present(table.select("feature", "n", "w", "note"))


def changepoints_whole(spark, sf_dir):
    """Change points of every day's whole series, all rows in the order of their time."""
    table = segmentation.segment(_rows(spark, sf_dir), SERIES, ["date"], penalty=SERIES_PENALTY)
    return present(table.select("date", "feature", "position", "tx_datetime", "level"))


def levene_stat(spark, sf_dir):
    table = _spread(spark, sf_dir).withColumn("levene_p", f_upper("levene", F.lit(1.0), "levene_df"))
    return present(table.select("date", "feature", "levene", "levene_df", "levene_p"))


def ttest_stat(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    moments = materialize(drift.day_moments(rows, FEATURES), "moments")
    table = drift.pooled_t(drift.paired_moments(moments, _calendar(moments)))
    return present(table.select("date", "feature", "t", "t_df", student_t_two_sided("t", "t_df").alias("t_p")))


def mannwhitney_stat(spark, sf_dir):
    table = drift.rank_summary(_cells(spark, sf_dir))
    return present(table.select("date", "feature", "n1", "n2", "u", "ties", "z", drift.mann_whitney_p().alias("u_p")))


def ks_two_sample(spark, sf_dir):
    return present(drift.rank_summary(_cells(spark, sf_dir)).select("date", "feature", "ks", "ks_p"))


def psi(spark, sf_dir):
    return present(_spread(spark, sf_dir).select("date", "feature", "psi"))


def chi_square(spark, sf_dir):
    return present(drift.rank_summary(_cells(spark, sf_dir, CATEGORICAL)).select("date", "feature", "chi2", "chi2_df"))


def drift_verdict(spark, sf_dir):
    return present(_compare(spark, sf_dir).select("date", "feature", "verdict", "note"))


def drift_test_log(spark, sf_dir):
    log = drift.test_log(_compare(spark, sf_dir))
    return present(log.withColumn("passed", F.col("passed").cast("string")), 4)


def drifted_columns(spark, sf_dir):
    return present(drift.drifted_columns(_compare(spark, sf_dir)))


def average_ranks(spark, sf_dir):
    return present(ranks.average_ranks(_rows(spark, sf_dir), ["date"], "tx_amount"))


def normality_k2(spark, sf_dir):
    table = drift.omnibus(drift.day_moments(_rows(spark, sf_dir), FEATURES))
    out = table.select("date", "feature", "n", "k2", "p_value", F.col("normal").cast("int").alias("normal"))
    return present(out, doubles=("normal",))


def changepoint_series(spark, sf_dir):
    """The slot means that the change-point search reads."""
    return present(changepoint.slot_means(_rows(spark, sf_dir), FEATURES, "tx_datetime", "date"))


def changepoints(spark, sf_dir):
    return present(changepoint.change_points(_rows(spark, sf_dir), FEATURES))


QUERIES = {
    f.__name__: f
    for f in [
        normality_jb,
        normality_sw,
        normality_sw_total,
        changepoints_whole,
        levene_stat,
        ttest_stat,
        mannwhitney_stat,
        ks_two_sample,
        psi,
        chi_square,
        drift_verdict,
        drift_test_log,
        drifted_columns,
        average_ranks,
        normality_k2,
        changepoint_series,
        changepoints,
    ]
}

_STEPS = 2000


def _integral(density: str, upper: str) -> str:
    """Composite Simpson rule over [0, upper] for a density written in ``x``."""
    x = f"(i * {upper} / {_STEPS}.0::double)"
    factor = f"case when i = 0 or i = {_STEPS} then 1 when i % 2 = 1 then 4 else 2 end"
    body = density.replace("x", x)
    return f"list_sum(list_transform(range(0, {_STEPS + 1}), lambda i: ({factor}) * ({body}))) * {upper} / {3 * _STEPS}.0::double"


def _normal_p(z: str) -> str:
    upper = f"least(abs({z}), 9.0::double)"
    density = "0.3989422804014327::double * pow(2.718281828459045::double, -(x) * (x) / 2)"
    return f"greatest(0.0::double, 1 - 2 * {_integral(density, upper)})"


def _t_p(t: str, df: str) -> str:
    upper = f"least(abs({t}), 10.0::double)"
    density = f"pow(1 + (x) * (x) / {df}, -({df} + 1) / 2)"
    scale = f"pow(2.718281828459045::double, lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt({df} * 3.141592653589793::double)"
    return f"greatest(0.0::double, 1 - 2 * {scale} * {_integral(density, upper)})"


_MOMENTS = f"""
long as ({unpivot_sql('cleaned', 'date')}),
centre as (select date, "column", avg(v) as m, var_pop(v) as s2 from long group by all),
moments as (select l.date, l."column" as feature, count(v) as n, any_value(m) as mean, var_samp(v) as var,
  case when any_value(s2) > 0 then avg((v - m) ** 3) / any_value(s2) ** 1.5 end as skew,
  case when any_value(s2) > 0 then avg((v - m) ** 4) / any_value(s2) ** 2 - 3 end as kurt
  from long l join centre c on l.date = c.date and l."column" = c."column" group by l.date, l."column"),
jb as (select *, n / 6.0::double * (skew * skew + kurt * kurt / 4.0::double) as jb from moments),
jbp as (select *, pow(2.718281828459045::double, -jb / 2) as p from jb)"""
_K2 = """
k2a as (select *, n::double as m, skew * sqrt((n + 1.0::double) * (n + 3) / (6 * (n - 2.0::double))) as y,
  3 * (n * n + 27.0::double * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5.0::double) * (n + 7) * (n + 9)) as beta,
  (kurt + 3 - 3 * (n - 1.0::double) / (n + 1)) / sqrt(24.0::double * n * (n - 2) * (n - 3) / ((n + 1.0::double) * (n + 1) * (n + 3) * (n + 5))) as x,
  6 * (n * n - 5.0::double * n + 2) / ((n + 7.0::double) * (n + 9)) * sqrt(6 * (n + 3.0::double) * (n + 5) / (n * (n - 2.0::double) * (n - 3))) as root
  from moments where n >= 8),
k2b as (select *, sqrt(2 * (beta - 1)) - 1 as w2, 6 + 8 / root * (2 / root + sqrt(1 + 4 / (root * root))) as a from k2a),
k2c as (select *, 1 + x * sqrt(2 / (a - 4)) as under, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5::double * ln(w2)) as z1 from k2b),
k2d as (select *, case when under <> 0 then (1 - 2 / (9 * a) - sign(under) * cbrt((1 - 2 / a) / abs(under))) / sqrt(2 / (9 * a)) end as z2 from k2c),
k2s as (select t.date, t.feature, t.n, z1 * z1 + z2 * z2 as k2 from moments t left join k2d using (date, feature))"""
_PAIRS = """
pairs as (
  select c.date, "column" as feature, v as value, 1 as cur from long l join cal c on l.date = c.date where prev_date is not null
  union all
  select c.date, "column", v, 0 from long l join cal c on l.date = c.prev_date)"""
_BASE = f"{CLEAN}, {CALENDAR}, {_MOMENTS}, {_PAIRS}"
_T = """
tt as (select a.date, a.feature, (a.n + b.n - 2)::double as t_df,
  ((a.n - 1) * a.var + (b.n - 1) * b.var) / (a.n + b.n - 2) as pooled, a.mean - b.mean as diff,
  1.0::double / a.n + 1.0::double / b.n as inv
  from moments a join cal c on c.date = a.date join moments b on b.date = c.prev_date and b.feature = a.feature),
tstat as (select date, feature, t_df, case when pooled > 0 then diff / sqrt(pooled * inv) end as t from tt)"""
_CELLS = """
cells as (select date, feature, value, sum(cur)::bigint as n_cur, sum(1 - cur)::bigint as n_ref from pairs group by all),
axis as (select *, coalesce(sum(n_cur) over before, 0) as b_cur, coalesce(sum(n_ref) over before, 0) as b_ref,
    sum(n_cur) over whole as n1, sum(n_ref) over whole as n2 from cells
  window before as (partition by date, feature order by value rows between unbounded preceding and 1 preceding),
    whole as (partition by date, feature)),
sums as (select date, feature, n1::double as n1, n2::double as n2,
    sum(n_cur * (b_cur + b_ref + (n_cur + n_ref + 1) / 2.0::double)) as rank_sum,
    sum((n_cur + n_ref)::double ** 3 - (n_cur + n_ref)) as ties,
    max(abs((b_cur + n_cur)::double / n1 - (b_ref + n_ref)::double / n2)) as ks,
    sum((n_cur - (n_cur + n_ref)::double * n1 / (n1 + n2)) ** 2 / ((n_cur + n_ref)::double * n1 / (n1 + n2))
      + (n_ref - (n_cur + n_ref)::double * n2 / (n1 + n2)) ** 2 / ((n_cur + n_ref)::double * n2 / (n1 + n2))) as chi2,
    count(*) - 1 as chi2_df
  from axis group by date, feature, n1, n2),
mw as (select *, rank_sum - n1 * (n1 + 1) / 2 as u,
    n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1))) as spread from sums),
mwz as (select *, case when spread > 0 then (greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5::double) / sqrt(spread) end as z,
    ks * sqrt(n1 * n2 / (n1 + n2)) as scaled from mw)"""
_KS_P = """case when scaled < 0.2::double then 1.0::double else greatest(0.0::double, least(1.0::double, 2 * list_sum(
  list_transform(range(1, 101), lambda k: (case when k % 2 = 1 then 1 else -1 end)
    * pow(2.718281828459045::double, -2.0::double * k * k * scaled * scaled))))) end"""
_LEVENE = """
med as (select date, feature, cur, median(value) as med from pairs group by all),
dev as (select p.date, p.feature, p.cur, abs(value - med) as z from pairs p join med m using (date, feature, cur)),
lev1 as (select date, feature, cur, count(*)::double as n, avg(z) as zi, var_pop(z) * count(*) as ss from dev group by all),
lev2 as (select date, feature, sum(n) as n, sum(n * zi) / sum(n) as zz, sum(ss) as within from lev1 group by all),
lev as (select a.date, a.feature, any_value(b.n) - 2 as levene_df,
  case when any_value(within) > 0 then (any_value(b.n) - 2) * sum(a.n * (zi - zz) ** 2) / any_value(within) end as levene
  from lev1 a join lev2 b using (date, feature) group by all)"""
_U_P = f"case when z is not null then least(1.0::double, case when z < 0 then 2 - ({_normal_p('z')}) else {_normal_p('z')} end) end"
_LEV_P = f"case when levene is not null then {_t_p('sqrt(levene)', 'levene_df')} end"
_T_P = f"case when t is not null then {_t_p('t', 't_df')} end"
_CHI_P = f"""case when chi2_df <= 0 then 1.0::double when chi2_df = 1 then {_normal_p('sqrt(chi2)')}
  when chi2_df = 2 then pow(2.718281828459045::double, -chi2 / 2) end"""
# Upper tail of chi-square for any whole number of degrees: sums of chi2 / 2 powers in logarithms.
_CHI_ANY = f"""case when chi2_df <= 0 then 1.0::double when chi2 <= 0 then 1.0::double
  when chi2_df % 2 = 0 then least(1.0::double, list_sum(list_transform(range(0, chi2_df // 2),
    lambda j: exp(-chi2 / 2 + j * ln(chi2 / 2) - lgamma(j + 1)))))
  else least(1.0::double, {_normal_p('sqrt(chi2)')} + coalesce(list_sum(list_transform(range(1, (chi2_df - 1) // 2 + 1),
    lambda j: exp(-chi2 / 2 + (j - 0.5::double) * ln(chi2 / 2) - lgamma(j + 0.5::double)))), 0)) end"""
_PSI = """
edges as (select date, feature, j, max(case when b_ref <= (n2 * j + 9) // 10 - 1 and (n2 * j + 9) // 10 - 1 < b_ref + n_ref
    then value end) as edge from axis, (select unnest(range(1, 10)) as j) group by all),
edge_lists as (select date, feature, list_distinct(list(edge)) as e from edges group by all),
bins as (select c.date, c.feature, len(list_filter(e, lambda x: x < value)) as bin, sum(n_cur) as c, sum(n_ref) as rr
  from cells c join edge_lists using (date, feature) group by all),
shares as (select b.date, b.feature, greatest(c::double / n1, 0.0001::double) as p, greatest(rr::double / n2, 0.0001::double) as q
  from bins b join sums s on s.date = b.date and s.feature = b.feature),
psi as (select date, feature, sum((p - q) * ln(p / q)) as psi from shares group by all)"""
_ALL = f"""{_BASE}, {_T}, {_CELLS}, {_LEVENE}, {_PSI},
tests as (select m.date, m.feature, a.jb as jb_cur, a.p as jb_p_cur, b.jb as jb_ref, b.p as jb_p_ref, t, t_df, {_T_P} as t_p,
    levene, levene_df, {_LEV_P} as levene_p, u, {_U_P} as u_p, ks, {_KS_P} as ks_p, chi2, chi2_df, {_CHI_ANY} as chi2_p, psi
  from mwz m join cal c on c.date = m.date
  join jbp a on a.date = m.date and a.feature = m.feature
  join jbp b on b.date = c.prev_date and b.feature = m.feature
  join tstat t on t.date = m.date and t.feature = m.feature
  join lev l on l.date = m.date and l.feature = m.feature
  join psi s on s.date = m.date and s.feature = m.feature)"""
_LOG = [
    ("jarque_bera_cur", "jb_cur", "jb_p_cur"),
    ("jarque_bera_ref", "jb_ref", "jb_p_ref"),
    ("levene", "levene", "levene_p"),
    ("student_t", "t", "t_p"),
    ("mann_whitney", "u", "u_p"),
    ("kolmogorov_smirnov", "ks", "ks_p"),
    ("chi_square", "chi2", "chi2_p"),
    ("stability_index", "psi", "null"),
]
_NOTE = """case when jb_p_cur >= 0.05::double and jb_p_ref >= 0.05::double and levene_p < 0.05::double
  then 'unequal_variance' else '' end"""
_KEY = "cast(date as varchar) as date, feature"



def _shapiro_sql(by: str) -> str:
    """W from the rank of every row."""
    part = f"partition by {by}feature"
    chain = "select * from sw where size >= 3 and varied"
    for name, text in normality.weight_steps().items():
        chain = f"select *, {text} as {name} from ({chain})"
    key = "cast(k.date as varchar) as date, " if by else ""
    on = f"k.feature = f.feature{' and k.date = f.date' if by else ''}"
    return f"""with {CLEAN}, long as ({unpivot_sql('cleaned', 'date')}),
      placed as (select {by}"column" as feature, v from long where v is not null),
      ranked as (select *, row_number() over ({part} order by v) as i, count(*) over ({part}) as n, avg(v) over ({part}) as mean from placed),
      off as (select *, v - mean as d, {normality.order_score('i', 'n')} as m from ranked),
      sw as (select {by}feature, any_value(n) as size, min(v) < max(v) as varied, sum(m * d) as mx, sum(m * m) as mm, sum(d * d) as ss,
        max(case when i = 1 then d end) as x1, max(case when i = 2 then d end) as x2,
        max(case when i = n - 1 then d end) as y2, max(case when i = n then d end) as y1 from off group by {by}feature)
      select {key}k.feature, k.size as n, case when f.fit is not null then {r('least(1.0::double, f.fit * f.fit / f.ss)')} end as w,
        case when k.size < 3 then 'too_few' when not k.varied then 'constant' when k.size > 5000 then 'beyond_5000' else '' end as note
      from sw k left join ({chain}) f on {on}"""


_SERIES = f"""with recursive {CLEAN}, long as (
        select date, tx_datetime, "column" as feature, v from ({" union all ".join(
          f"select date, tx_datetime, '{c}' as \"column\", cast({c} as double) as v from cleaned" for c in SERIES)})),
      stats as (select date, feature, avg(v) as mean, stddev_pop(v) as std, count(*) as size from long group by all having min(v) < max(v)),
      cells as (select l.date, l.feature, tx_datetime, count(*) as n, sum((v - mean) / std) as s
        from long l join stats t on t.date = l.date and t.feature = l.feature group by all),
      series as (select date, feature, tx_datetime,
          coalesce(sum(n) over w, 0)::bigint as bef, coalesce(sum(s) over w, 0) as sb from cells
        window w as (partition by date, feature order by tx_datetime rows between unbounded preceding and 1 preceding)),
      segs as (
        select date, feature, 0::bigint as a, size as b, 0.0::double as sa, 0.0::double as sz, 0::bigint as lev, null::timestamp as at_time, size from stats
        union all
        select date, feature, case when half = 0 then a else bef end, case when half = 0 then bef else b end,
          case when half = 0 then sa else sb end, case when half = 0 then sb else sz end, lev + 1, case when half = 1 then tx_datetime end, size
        from (select *, row_number() over (partition by date, feature, a order by gain desc, bef) as place
              from (select g.*, c.bef, c.sb, c.tx_datetime, round((c.sb - sa) * (c.sb - sa) / (c.bef - a) + (sz - c.sb) * (sz - c.sb) / (b - c.bef)
                      - (sz - sa) * (sz - sa) / (b - a), 6) as gain
                    from segs g join series c on c.date = g.date and c.feature = g.feature and c.bef >= a + 2 and c.bef <= b - 2)), (values (0), (1)) h(half)
        where place = 1 and gain > {SERIES_PENALTY}::double * ln(size::double))"""


ORACLE = {
    "changepoints_whole": f"""{_SERIES} select cast(date as varchar) as date, feature, a as position,
      strftime(at_time, '%Y-%m-%d %H:%M:%S.%f') as tx_datetime, lev as level from segs where at_time is not null""",
    "normality_sw": _shapiro_sql("date, "),
    "normality_sw_total": _shapiro_sql(""),
    "normality_jb": f"""with {CLEAN}, {_MOMENTS} select {_KEY}, n, {r('jb', 4)} as jb, {r('p', 4)} as p_value,
      (p >= 0.05::double)::int::double as normal from jbp""",
    "normality_k2": f"""with {CLEAN}, {_MOMENTS}, {_K2} select {_KEY}, n, {r('k2')} as k2,
      {r('exp(-k2 / 2)')} as p_value, (exp(-k2 / 2) >= 0.05::double)::int::double as normal from k2s""",
    "levene_stat": f"""with {_BASE}, {_LEVENE} select {_KEY}, {r('levene')} as levene, levene_df,
      {r(_LEV_P)} as levene_p from lev""",
    "ttest_stat": f"with {_BASE}, {_T} select {_KEY}, {r('t')} as t, t_df, {r(_T_P)} as t_p from tstat",
    "mannwhitney_stat": f"""with {_BASE}, {_CELLS} select {_KEY}, n1::bigint as n1, n2::bigint as n2, u, ties, {r('z')} as z,
      {r(_U_P)} as u_p from mwz""",
    "ks_two_sample": f"with {_BASE}, {_CELLS} select {_KEY}, {r('ks')} as ks, {r(_KS_P)} as ks_p from mwz",
    "psi": f"with {_BASE}, {_CELLS}, {_PSI} select {_KEY}, {r('psi')} as psi from psi",
    "chi_square": f"""with {_BASE}, {_CELLS} select {_KEY}, {r('chi2')} as chi2, chi2_df from mwz
      where feature in ('tx_fraud', 'tx_fraud_scenario')""",
    "drift_verdict": f"""with {_ALL} select {_KEY},
      case when jb_p_cur is null or jb_p_ref is null then 'undecided'
        when (jb_p_cur >= 0.05::double) <> (jb_p_ref >= 0.05::double) then 'different_nature'
        when jb_p_cur >= 0.05::double then case when t_p >= 0.05::double then 'similar' else 'different' end
        when u_p >= 0.05::double then 'similar' else 'different' end as verdict,
      {_NOTE} as note from tests""",
    "drift_test_log": f"with {_ALL}, log as ("
    + " union all ".join(
        f"select date, feature, '{t}' as test, {s}::double as statistic, {p}::double as p_value, {_NOTE} as note from tests" for t, s, p in _LOG
    )
    + f") select {_KEY}, test, {r('statistic', 4)} as statistic, {r('p_value', 4)} as p_value, "
    + "cast(p_value >= 0.05::double as varchar) as passed, note from log",
    "drifted_columns": f"""with {_ALL}, p as (select date,
        case when feature in ('tx_fraud', 'tx_fraud_scenario') then {_CHI_P} else ks_p end as p from tests)
      select cast(date as varchar) as date, count(*) filter (where p < 0.05::double) as drifted, count(p) as compared,
        {r('count(*) filter (where p < 0.05::double) / count(p)')} as share from p group by date""",
    "changepoint_series": f"""with {CLEAN}, s as (select date,
        (hour(tx_datetime) * 3600 + minute(tx_datetime) * 60 + second(tx_datetime)) * 1000 // 86400 as slot,
        {", ".join(NUMERIC_COLUMNS)} from cleaned),
      l as ({" union all ".join(f"select date, slot, '{c}' as feature, {c} as v from s" for c in NUMERIC_COLUMNS)})
      select cast(date as varchar) as date, feature, slot, {r('avg(v)')} as value from l group by date, feature, slot""",
    "average_ranks": f"""with {CLEAN}, d as (select date, tx_amount, count(*) as n from cleaned group by all),
      s as (select *, coalesce(sum(n) over (partition by date order by tx_amount rows between unbounded preceding
          and 1 preceding), 0) as b, sum(n) over (partition by date) as total from d)
      select cast(date as varchar) as date, {r('tx_amount')} as tx_amount, n, {r('b + (n + 1) / 2.0::double')} as avg_rank,
        {r('(b + n)::double / total')} as ecdf from s""",
}
