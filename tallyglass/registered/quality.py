"""Queries over scored rows: class weights, splits, metrics, bootstrap comparison, registry decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyglass import adapters
from tallyglass.operators import bootstrap, cleaning, registry, sampling, scoring
from tallyglass.registered.common import CLEAN, HASH32, PRED, present, r

REPLICATES = 100
FRACTION = 0.1


def _clean(spark, sf_dir):
    return cleaning.clean(adapters.transactions(spark, sf_dir))


def _preds(spark, sf_dir):
    return adapters.predictions(spark, sf_dir)


def class_weights(spark, sf_dir):
    return present(sampling.class_weights(_clean(spark, sf_dir)))


def weighted_rows(spark, sf_dir):
    rows = sampling.with_balanced_weight(_clean(spark, sf_dir))
    rows = rows.withColumn("class_weight", sampling.constant_class_weight())
    return present(rows.select("transaction_id", "tx_fraud", "weight", "class_weight"))


def hash_split(spark, sf_dir):
    train, test = sampling.hash_split(_clean(spark, sf_dir), "transaction_id")
    tagged = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return present(tagged.select("transaction_id", "part"))


def hash_sample(spark, sf_dir):
    return present(sampling.hash_sample(_clean(spark, sf_dir), "transaction_id", 1000).select("transaction_id", "tx_amount"))


def hash_sample_by_day(spark, sf_dir):
    rows = cleaning.with_day(_clean(spark, sf_dir))
    return present(sampling.hash_sample(rows, "transaction_id", 20, "d-", ["date"]).select("date", "transaction_id"))


def poisson_weights(spark, sf_dir):
    drawn = bootstrap.replicate_counts(adapters.read_table(spark, sf_dir, "events").select("event_id", "value"), "event_id", 20, 1.0)
    table = drawn.groupBy("replicate").agg(
        F.sum("copies").alias("copies"),
        (F.sum(F.col("copies") * F.col("value")) / F.sum("copies")).alias("mean_value"),
    )
    return present(table)


def confusion(spark, sf_dir):
    preds = cleaning.with_day(_preds(spark, sf_dir), "ts")
    return present(scoring.confusion(preds, ["model", "date"]))


def prf1(spark, sf_dir):
    preds = cleaning.with_day(_preds(spark, sf_dir), "ts")
    table = scoring.confusion(preds, ["model", "date"])
    return present(
        table.select(
            "model",
            "date",
            scoring.precision().alias("precision"),
            scoring.recall().alias("recall"),
            scoring.f_beta().alias("f1"),
        )
    )


def fbeta(spark, sf_dir):
    table = scoring.confusion(_preds(spark, sf_dir), ["model"])
    return present(
        table.select("model", scoring.f_beta(0.5).alias("f_half"), scoring.f_beta(2.0).alias("f_two"))
    )


def auc_weighted(spark, sf_dir):
    preds = cleaning.with_day(_preds(spark, sf_dir), "ts")
    plain = scoring.area_under_roc(preds, ["model", "date"])
    weighted = scoring.area_under_roc(preds, ["model", "date"], "weight").withColumnRenamed("auc", "auc_weighted")
    return present(plain.join(weighted, ["model", "date"]))


def f1_weighted(spark, sf_dir):
    return present(scoring.class_f1(_preds(spark, sf_dir), ["model"]))


def accuracy_weighted(spark, sf_dir):
    return present(scoring.class_f1(_preds(spark, sf_dir), ["model"], weight="weight"))


def evaluate_models(spark, sf_dir):
    return present(scoring.evaluate(_preds(spark, sf_dir), ["model"], "weight"))


def business_limits(spark, sf_dir):
    return present(scoring.business_limits(_preds(spark, sf_dir), ["model"]))


def _intervals(spark, sf_dir):
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return bootstrap.bootstrap_ci(_preds(spark, sf_dir), REPLICATES, 95.0, FRACTION, spread=tasks)


def bootstrap_ci(spark, sf_dir):
    return present(_intervals(spark, sf_dir))


def bootstrap_ci_paired(spark, sf_dir):
    return present(bootstrap.bootstrap_ci(_preds(spark, sf_dir), 40, 90.0, FRACTION, weight=None, paired=True))


def ab_compare(spark, sf_dir):
    table = bootstrap.compare(_intervals(spark, sf_dir))
    return present(table.withColumn("improved", F.coalesce(F.col("improved").cast("string"), F.lit("unknown"))))


def ab_verdict(spark, sf_dir):
    table = bootstrap.compare(_intervals(spark, sf_dir))
    return present(bootstrap.verdict(table))


def _daily_versions(spark, sf_dir):
    """One registered version per model and day, with that day's area under ROC."""
    preds = cleaning.with_day(_preds(spark, sf_dir), "ts")
    area = scoring.area_under_roc(preds, ["model", "date"])
    runs = area.select("model", F.col("date").alias("ts"), F.concat_ws("-", "model", "date").alias("run_id"), "auc")
    return registry.number_versions(runs)


def registered_versions(spark, sf_dir):
    return present(_daily_versions(spark, sf_dir).select("model", "version", "run_id", "ts"))


def champion_history(spark, sf_dir):
    return present(registry.promotion_history(_daily_versions(spark, sf_dir)))


def quality_alert(spark, sf_dir):
    table = registry.quality_alerts(_daily_versions(spark, sf_dir)).drop("ts", "run_id")
    return present(table, doubles=("roll_back_to",))


def _alias_changes(spark, sf_dir):
    stages = "map('purchase', 'Production', 'signup', 'Staging', 'error', 'Archived', 'click', 'Shadow', 'view', 'None')"
    rows = adapters.read_table(spark, sf_dir, "events").selectExpr(
        "user_id as model",
        "event_id as version",
        f"{stages}[event_type] as stage",
        "case when value > 20 then 'alias' else 'tag' end as source",
        "ts",
    )
    return rows.withColumn("alias", registry.stage_alias(F.col("stage")))


def alias_current(spark, sf_dir):
    return present(registry.current_aliases(_alias_changes(spark, sf_dir)))


def champion_lookup(spark, sf_dir):
    return present(registry.resolve(_alias_changes(spark, sf_dir)))


def champion_run_metrics(spark, sf_dir):
    changes = _alias_changes(spark, sf_dir)
    events = adapters.read_table(spark, sf_dir, "events")
    versions = events.selectExpr("user_id as model", "event_id as version", "concat('run-', event_id) as run_id")
    runs = events.select(
        F.concat(F.lit("run-"), "event_id").alias("run_id"),
        F.lit("metric").alias("kind"),
        "ts",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("key"), (F.col("value") / scale).cast("string").alias("value"))
                    for name, scale in (("auc", 500.0), ("accuracy", 600.0), ("f1", 700.0))
                ]
            )
        ).alias("m"),
    ).select("run_id", "kind", "ts", "m.*")
    return present(registry.champion_metrics(changes, versions, runs))


def _trials(spark, sf_dir):
    """One trial per user: the candidate's quality on that user's events."""
    events = adapters.read_table(spark, sf_dir, "events")
    owner = events.select(F.col("event_id").alias("key"), F.col("user_id").alias("trial_id"))
    preds = _preds(spark, sf_dir).filter("model = 'candidate'").join(owner, "key")
    area = scoring.area_under_roc(preds, ["trial_id"])
    table = scoring.confusion(preds, ["trial_id"]).join(area, "trial_id")
    trials = table.select(
        "trial_id",
        "auc",
        scoring.precision().alias("precision"),
        scoring.recall().alias("recall"),
    )
    return registry.objective(trials)


def trial_leaderboard(spark, sf_dir):
    return present(registry.leaderboard(_trials(spark, sf_dir)))


def best_trial(spark, sf_dir):
    return present(registry.best_trial(_trials(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in [
        class_weights,
        weighted_rows,
        hash_split,
        hash_sample,
        hash_sample_by_day,
        poisson_weights,
        confusion,
        prf1,
        fbeta,
        auc_weighted,
        f1_weighted,
        accuracy_weighted,
        evaluate_models,
        business_limits,
        bootstrap_ci,
        bootstrap_ci_paired,
        ab_compare,
        ab_verdict,
        registered_versions,
        champion_history,
        quality_alert,
        alias_current,
        champion_lookup,
        champion_run_metrics,
        trial_leaderboard,
        best_trial,
    ]
}

_PRED_DAY = PRED + ", pd as (select *, cast(ts as date) as date from preds)"


def _counts(source: str, by: str, weight: str = "1") -> str:
    cells = [("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0)]
    sums = ", ".join(
        f"sum(case when label = {a} and prediction = {p} then {weight} else 0 end) as {n}" for n, a, p in cells
    )
    return f"select {by}, {sums} from {source} group by {by}"


def _area(source: str, by: str, weight: str = "1", name: str = "area") -> str:
    """CTEs ending in ``name`` (by, auc, tp, fp, fn, tn)."""
    return f"""{name}_cells as ({_counts(source, f'{by}, score', weight)}),
{name}_ranked as (select *, tp + fn as pos, fp + tn as neg,
  coalesce(sum(fp + tn) over (partition by {by} order by score rows between unbounded preceding and 1 preceding), 0) as nb
  from {name}_cells),
{name} as (select {by}, case when sum(pos) > 0 and sum(neg) > 0
    then sum(pos * (nb + neg / 2.0::double)) / (sum(pos)::double * sum(neg)) end as auc,
  sum(tp)::double as tp, sum(fp)::double as fp, sum(fn)::double as fn, sum(tn)::double as tn
  from {name}_ranked group by {by})"""


def _div(a: str, b: str, otherwise: str = "0") -> str:
    return f"case when {b} > 0 then ({a})::double / ({b}) else {otherwise} end"


_PREC = _div("tp", "tp + fp")
_REC = _div("tp", "tp + fn")
_F1 = _div("2 * tp", "2 * tp + fp + fn")
_ACC = _div("tp + tn", "tp + tn + fp + fn", "null")
_F1N = _div("2 * tn", "2 * tn + fp + fn")
_F1W = f"((tp + fn) * ({_F1}) + (tn + fp) * ({_F1N})) / (tp + fn + tn + fp)"


def _draws_sql(source: str, columns: str, prefix: str, key: str, n: int, rate: float) -> str:
    steps = " + ".join(f"(u > '{c!r}'::double)::bigint" for c in sampling.poisson_cdf(rate))
    return f"""digests as (select {columns}, b.block, sha256({prefix}{key} || '-' || b.block) as digest
  from {source}, (select unnest(range(0, {(n + 7) // 8})) as block) b),
words as (select *, block * 8 + w.i as replicate,
  (('0x' || substr(digest, 8 * w.i + 1, 8))::bigint + 0.5::double) / 4294967296.0::double as u
  from digests, (select unnest(range(0, 8)) as i) w),
drawn as (select * exclude (u), {steps} as copies from words where replicate < {n}),
taken as (select * from drawn where copies > 0)"""


def _ci_ctes(n: int, level: float, rate: float, weight: str, prefix: str) -> str:
    tail = (100.0 - level) / 200.0
    return f"""{PRED}, {_draws_sql('preds', 'model, key, label, weight, score, prediction', prefix, 'key', n, rate)},
{_area('taken', 'model, replicate', f'copies * {weight}', 'rep')},
{_area('preds', 'model', weight, 'whole')},
vals as (select model, 'auc' as metric, auc as value from rep
  union all select model, 'accuracy', {_ACC} from rep union all select model, 'f1', {_F1W} from rep),
points as (select model, 'auc' as metric, auc as point from whole
  union all select model, 'accuracy', {_ACC} from whole union all select model, 'f1', {_F1W} from whole),
ci as (select model, metric, quantile_cont(value, {tail}) as low, quantile_cont(value, {1 - tail}) as high,
  count(value) as replicates, any_value(point) as point
  from vals join points using (model, metric) group by model, metric)"""


_CI = _ci_ctes(REPLICATES, 95.0, FRACTION, "weight", "model || '-' || ")
_CI_OUT = f"select model, metric, {r('low')} as low, {r('high')} as high, replicates, {r('point')} as point from ci"
_CMP = """
cmp as (select b.metric, b.point as base_point, b.low as base_low, b.high as base_high, c.point as cand_point,
    c.low as cand_low, c.high as cand_high,
    case when b.high < c.low then 'true' when c.high < b.low then 'false' else 'unknown' end as improved,
    (c.point - b.point) / b.point * 100.0::double as change_percent
  from ci b join ci c on b.metric = c.metric and b.model = 'baseline' and c.model = 'candidate')"""
_VERSIONS = f"""{_PRED_DAY}, {_area('pd', 'model, date')},
versions as (select model, date as ts, model || '-' || date as run_id, auc,
  row_number() over (partition by model order by date) as version from area)"""
_CHANGES = """
changes as (select user_id as model, event_id as version,
  case event_type when 'purchase' then 'champion' when 'signup' then 'challenger' when 'error' then 'archived'
    when 'click' then 'shadow' else 'none' end as alias,
  case when value > 20 then 'alias' else 'tag' end as source, ts from events)"""
_TRIALS = f"""{PRED}, owned as (select p.*, e.user_id as trial_id from preds p join events e on e.event_id = p.key
    where model = 'candidate'),
  {_area('owned', 'trial_id')},
  trials as (select trial_id, auc, {_PREC} as precision, {_REC} as recall from area),
  scored as (select *, coalesce(1 - (0.7::double * auc + case when recall > 0.8::double then 0.3::double * precision
    else 0 end), 1.0::double) as loss from trials)"""
_TRIAL_OUT = ", ".join(["trial_id", *[f"{r(c)} as {c}" for c in ("auc", "precision", "recall", "loss")]])
_CHAMPION = """
champ as (select model, source, arg_max(version, ts) as version from changes where alias = 'champion' group by all),
chosen as (select model, version, source from champ
  qualify row_number() over (partition by model order by case source when 'alias' then 0 else 1 end) = 1)"""

ORACLE = {
    "class_weights": f"""with {CLEAN}, c as (select tx_fraud, count(*) as n from cleaned group by 1)
      select cast(tx_fraud as bigint) as tx_fraud, n as "count",
        {r('(select sum(n) from c)::double / ((select count(*) from c) * n)')} as weight from c""",
    "weighted_rows": f"""with {CLEAN}, c as (select tx_fraud, count(*) as n from cleaned group by 1),
      w as (select tx_fraud, (select sum(n) from c)::double / ((select count(*) from c) * n) as weight from c)
      select transaction_id, cast(cleaned.tx_fraud as bigint) as tx_fraud, {r('weight')} as weight,
        case when cleaned.tx_fraud = 1 then 10.0::double else 1.0::double end as class_weight
      from cleaned join w using (tx_fraud)""",
    "hash_split": f"""with {CLEAN} select transaction_id,
      case when {HASH32.format('cast(transaction_id as varchar)')} < round(0.8::double * 4294967296) then 'train' else 'test' end as part from cleaned""",
    "hash_sample": f"""with {CLEAN} select transaction_id, {r('tx_amount')} as tx_amount from cleaned
      order by {HASH32.format('cast(transaction_id as varchar)')}, transaction_id limit 1000""",
    "hash_sample_by_day": f"""with {CLEAN} select cast(date as varchar) as date, transaction_id from cleaned
      qualify row_number() over (partition by date
        order by {HASH32.format("'d-' || transaction_id")}, transaction_id) <= 20""",
    "poisson_weights": f"""with {_draws_sql('events', 'event_id, value', '', 'event_id', 20, 1.0)}
      select replicate, sum(copies)::bigint as copies, {r('sum(copies * value) / sum(copies)')} as mean_value
      from taken group by replicate""",
    "confusion": f"""with {_PRED_DAY}, c as ({_counts('pd', 'model, date')})
      select model, cast(date as varchar) as date, tp::bigint as tp, fp::bigint as fp, fn::bigint as fn, tn::bigint as tn
      from c""",
    "prf1": f"""with {_PRED_DAY}, c as ({_counts('pd', 'model, date')})
      select model, cast(date as varchar) as date, {r(_PREC)} as precision, {r(_REC)} as recall, {r(_F1)} as f1 from c""",
    "fbeta": f"""with {PRED}, c as ({_counts('preds', 'model')})
      select model, {r(_div('1.25 * tp', '1.25 * tp + 0.25 * fn + fp'))} as f_half,
        {r(_div('5 * tp', '5 * tp + 4 * fn + fp'))} as f_two from c""",
    "auc_weighted": f"""with {_PRED_DAY}, {_area('pd', 'model, date', '1', 'plain')},
      {_area('pd', 'model, date', 'weight', 'heavy')}
      select p.model, cast(p.date as varchar) as date, {r('p.auc')} as auc, {r('h.auc')} as auc_weighted
      from plain p join heavy h on p.model = h.model and p.date = h.date""",
    "f1_weighted": f"""with {PRED}, c as ({_counts('preds', 'model')})
      select model, {r(_ACC)} as accuracy, {r(_F1W)} as f1_weighted from c""",
    "accuracy_weighted": f"""with {PRED}, c as ({_counts('preds', 'model', 'weight')})
      select model, {r(_ACC)} as accuracy, {r(_F1W)} as f1_weighted from c""",
    "evaluate_models": f"""with {PRED}, {_area('preds', 'model', 'weight')}
      select model, {r('auc')} as auc, {r(_ACC)} as accuracy, {r(_PREC)} as precision, {r(_REC)} as recall,
        {r(_F1)} as f1, {r(_F1W)} as f1_weighted, tp, fp, fn, tn from area""",
    "business_limits": f"""with {PRED}, pm as (select *, strftime(ts, '%Y-%m') as month from preds),
      c as ({_counts('pm', 'model, month')}),
      l as (select model, month, sum(case when label = 1 and prediction = 0 then amount else 0 end) as loss
            from pm group by all),
      s as (select model, month, {_div('fp', 'fp + tn')} as fpr, loss,
              {_div('tp + fn', 'tp + fn + fp + tn')} as share from c join l using (model, month))
      select model, month, {r('fpr')} as false_positive_rate, {r('loss')} as loss, {r('share')} as fraud_share,
        (fpr <= 0.05::double)::bigint as type_one_ok, (loss <= 500000)::bigint as loss_ok,
        (share <= 0.02::double)::bigint as fraud_share_ok from s""",
    "bootstrap_ci": f"with {_CI} {_CI_OUT}",
    "bootstrap_ci_paired": f"with {_ci_ctes(40, 90.0, FRACTION, '1', '')} {_CI_OUT}",
    "ab_compare": f"""with {_CI}, {_CMP} select metric, {', '.join(f'{r(c)} as {c}' for c in
      ('base_point', 'base_low', 'base_high', 'cand_point', 'cand_low', 'cand_high', 'change_percent'))}, improved
      from cmp""",
    "ab_verdict": f"""with {_CI}, {_CMP}, t as (select count(*) filter (where improved = 'true') as improvements,
        count(*) filter (where improved = 'false') as deteriorations,
        count(*) filter (where improved = 'unknown') as inconclusive from cmp)
      select *, case when improvements > deteriorations then 'deploy' when deteriorations > improvements then 'keep'
        else 'inconclusive' end as decision from t""",
    "registered_versions": f"""with {_VERSIONS} select model, version, run_id, cast(ts as varchar) as ts from versions""",
    "champion_history": f"""with {_VERSIONS}, b as (select *, max(auc) over (partition by model order by version
        rows between unbounded preceding and 1 preceding) as best from versions)
      select model, version, run_id, cast(ts as varchar) as ts, {r('auc')} as auc, {r('best')} as best_before,
        case when version = 1 or auc > coalesce(best, '-infinity'::double) then 'champion' else 'challenger' end as alias,
        case when auc > best then {r('(auc - best) / best * 100.0::double')} end as improvement from b""",
    "quality_alert": f"""with {_VERSIONS}, p as (select *, lag(auc) over (partition by model order by version) as previous
        from versions),
      a as (select *, coalesce(auc < previous - 0.02::double, false) as fell from p)
      select model, version, {r('auc')} as auc, {r('previous')} as previous, fell::bigint as alert,
        case when fell then (select max(v.version) from a v where v.model = a.model and v.version < a.version
          and not v.fell)::double end as roll_back_to from a""",
    "alias_current": f"""with {_CHANGES} select model, alias, version,
        strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts from changes
      qualify row_number() over (partition by model, alias order by ts desc, version desc) = 1""",
    "champion_lookup": f"with {_CHANGES}, {_CHAMPION} select model, version, source from chosen",
    "champion_run_metrics": f"""with {_CHANGES}, {_CHAMPION}
      select 'run-' || version as run_id, c.model, c.version, c.source, {r('value / 500.0::double')} as auc,
        {r('value / 600.0::double')} as accuracy, {r('value / 700.0::double')} as f1
      from chosen c join events e on e.event_id = c.version""",
    "trial_leaderboard": f"""with {_TRIALS} select {_TRIAL_OUT},
      row_number() over (order by scored.auc desc nulls last, trial_id) as rank from scored""",
    "best_trial": f"with {_TRIALS} select {_TRIAL_OUT} from scored order by scored.loss, trial_id limit 1",
}
