"""Model-based operators.

Deep models have no SQL. A model of one round and depth 1, without sampling, is a stump, whose split
SQL can find exactly over columns with few values; the label is planted, so the best split is clear.
"""

from __future__ import annotations

from dataclasses import replace
from itertools import combinations

from pyspark.sql import functions as F

from featurelab.operators.folds import FOLD, IS_TRAIN
from featurelab.operators.forest import running_margins
from featurelab.operators.models import (
    BINARY,
    LABEL,
    TreeParams,
    contribution_importance,
    fit_folds,
    fold_frame,
    linear_importance,
    load_forests,
    model_importance,
    tree_importance,
    values_of,
)
from featurelab.operators.selectors.adversarial import HISTORY_SCHEMA
from featurelab.operators.selectors import (
    AdversarialSettings,
    CorrelationSettings,
    ForwardSettings,
    NoiseSettings,
    PermutationSettings,
    drop_adversarial,
    drop_correlated,
    select_forward,
    select_noise,
    select_permutation,
)
from featurelab.operators.splits import Splits, classify
from featurelab.operators.votes import mean_importance
from featurelab.plans.checks.inputs import (
    LINE_KEY,
    LINE_KEY_TEXT,
    document_features,
    hash_sql,
    moment,
    table,
)
from featurelab.sources.scratch import scratch_path
from featurelab.sources.sinks import write_report

QUERIES, SQL = {}, {}

SMALL = TreeParams(rounds=5, max_depth=3, min_rows_per_leaf=5, feature_fraction=1.0)


def _documents(spark, folder):
    docs = document_features(spark, folder).drop("toxic")
    return Splits(docs), classify(docs, "doc_id", "quality")


def _verdict(result, splits, features):
    """One row per analysed feature: kept or dropped."""
    dropped = set(result.drop)
    rows = [(c, c not in dropped) for c in features]
    return splits.train.sparkSession.createDataFrame(rows, "feature_name string, kept boolean")


def _importance(spark, folder, kind):
    splits, roles = _documents(spark, folder)
    frame = fold_frame(splits.train, roles.features, "quality", "doc_id", 3)
    if kind == "linear":
        return linear_importance(frame, roles.features, BINARY)
    return model_importance(frame, roles.features, fit_folds(frame, roles.features, BINARY, SMALL), kind)


def gain_importance_by_fold(spark, folder):
    return _importance(spark, folder, "gain")


def split_importance_by_fold(spark, folder):
    return _importance(spark, folder, "split")


def mean_contribution_by_feature(spark, folder):
    return mean_importance(_importance(spark, folder, "shap"))


def linear_contribution_by_feature(spark, folder):
    return mean_importance(_importance(spark, folder, "linear"))


def noise_selection(spark, folder):
    splits, roles = _documents(spark, folder)
    settings = NoiseSettings(cv_folds=3, selection_rate=0.6, num_boost_round=5, max_depth=3)
    result = select_noise(splits, roles, roles.features, settings, "binary_classification", ["doc_id"])
    return _verdict(result, splits, roles.features)


def permutation_selection(spark, folder):
    splits, roles = _documents(spark, folder)
    settings = PermutationSettings(cv_folds=3, selection_rate=0.6, num_boost_round=5, max_depth=3)
    result = select_permutation(splits, roles, roles.features, settings, "binary_classification", ["doc_id"])
    return result.reports["importances"]


def forward_selection(spark, folder):
    splits, roles = _documents(spark, folder)
    settings = ForwardSettings(
        cv_folds_importances=3, cv_folds_selection=3, num_boost_round_importances=5,
        num_boost_round_selection=5, tol=2, q=2, max_depth=3, valid_frac=0.3,
    )
    result = select_forward(splits, roles, roles.features, settings, "binary_classification", ["doc_id"])
    return result.reports["steps"]


def adversarial_removal(spark, folder):
    """Orders split by date, with a year column that gives the date away."""
    orders = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    late = F.col("o_orderdate") >= moment("1996-06-01 00:00:00")
    splits = Splits(orders.filter(~late), orders.filter(late))
    roles = classify(orders.drop("o_orderdate"), "o_orderkey", None)
    settings = AdversarialSettings(
        target_metric_value=0.6, cv_folds=3, num_boost_round=5, max_depth=3, max_features_to_remove=2
    )
    result = drop_adversarial(splits, roles, roles.numeric, settings, "binary_classification", ["o_orderkey"])
    return result.reports["history"]


def correlated_removal(spark, folder):
    """Lineitem numbers with two derived copies."""
    lines = table(spark, folder, "lineitem").withColumns(
        {
            "net": F.col("l_extendedprice") * (1 - F.col("l_discount")),
            "minus_quantity": -2 * F.col("l_quantity"),
            "returned": (F.col("l_returnflag") == "R").cast("int"),
        }
    )
    features = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net", "minus_quantity"]
    roles = classify(lines, "l_orderkey", "returned")
    trees = {"use_shap": True, "n_partitions": 3, "num_boost_round": 5, "max_depth": 3}
    settings = CorrelationSettings(threshold=0.95, importances=trees)
    splits = Splits(lines)
    result = drop_correlated(splits, roles, features, settings, "binary_classification", LINE_KEY)
    return _verdict(result, splits, features)


_FEW_VALUES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
_STUMP = TreeParams(
    rounds=1, max_depth=1, min_rows_per_leaf=5, row_fraction=1.0, feature_fraction=1.0, early_stopping_rounds=0
)


def _planted(spark, folder):
    """Lineitem with a label that follows the quantity in all but some rows."""
    exception = (F.col("l_discount") > 0.07) & (F.col("l_linenumber") < 3)
    label = ((F.col("l_quantity") > 25) | exception).cast("int")
    return table(spark, folder, "lineitem").withColumn("y", label)


def _stump_importance(spark, folder, kind):
    frame = fold_frame(_planted(spark, folder), _FEW_VALUES, "y", LINE_KEY, 3)
    models = fit_folds(frame, _FEW_VALUES, BINARY, _STUMP)
    return tree_importance(frame.df, models, _FEW_VALUES, kind)


def stump_gain_by_fold(spark, folder):
    return _stump_importance(spark, folder, "gain")


def stump_split_by_fold(spark, folder):
    return _stump_importance(spark, folder, "split")


def stump_noise_selection(spark, folder):
    lines = _planted(spark, folder)
    roles = classify(lines.select(*LINE_KEY[:1], *_FEW_VALUES, "y"), "l_orderkey", "y")
    settings = NoiseSettings(
        cv_folds=3, selection_rate=0.6, num_boost_round=1, max_depth=1, row_fraction=1.0, feature_fraction=1.0
    )
    splits = Splits(lines)
    result = select_noise(splits, roles, _FEW_VALUES, settings, "binary_classification", LINE_KEY)
    return _verdict(result, splits, _FEW_VALUES)


def stump_permutation(spark, folder):
    lines = _planted(spark, folder)
    roles = classify(lines.select(*LINE_KEY[:1], *_FEW_VALUES, "y"), "l_orderkey", "y")
    settings = PermutationSettings(
        cv_folds=3, selection_rate=0.6, num_boost_round=1, max_depth=1, row_fraction=1.0, feature_fraction=1.0
    )
    result = select_permutation(Splits(lines), roles, _FEW_VALUES, settings, "binary_classification", LINE_KEY)
    rounded = F.round("permutation_importance", 9).alias("permutation_importance")
    return result.reports["importances"].select("fold_id", "feature_name", rounded, "is_above_threshold")


def _stump_adversarial(spark, folder, **more):
    """Orders split by date: the year gives the date away, month and day do not."""
    dates = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderdate",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.dayofmonth("o_orderdate").alias("day"),
    )
    late = F.col("o_orderdate") >= moment("1996-06-01 00:00:00")
    splits = Splits(dates.filter(~late), dates.filter(late))
    roles = classify(dates.drop("o_orderdate"), "o_orderkey", None)
    settings = AdversarialSettings(
        target_metric_value=0.7, cv_folds=3, num_boost_round=1, max_depth=1, max_features_to_remove=2,
        row_fraction=1.0, feature_fraction=1.0, **more,
    )
    result = drop_adversarial(
        splits, roles, ["year", "month", "day"], settings, "binary_classification", ["o_orderkey"]
    )
    return result.reports["history"]


def stump_adversarial(spark, folder):
    history = _stump_adversarial(spark, folder)
    doubles = [c for c, kind in history.dtypes if kind == "double"]
    return history.withColumns({c: F.round(c, 9) for c in doubles})


def _best_split_sql(features):
    """The feature of the best split of each fold: the largest reduction of variance."""
    return f"""
    with r as (
        select cast({hash_sql(LINE_KEY_TEXT, 'fold42')} % 3 as int) as fold_id,
               {hash_sql(LINE_KEY_TEXT, 'noise42')} / 4294967296.0::double as noise_feature,
               cast(l_quantity > 25 or (l_discount > 0.07 and l_linenumber < 3) as int) as y,
               l_quantity, l_discount, l_tax, cast(l_linenumber as double) as l_linenumber
        from lineitem where {hash_sql(LINE_KEY_TEXT, 'split42')} >= 0.3 * 4294967296),
    v as (select fold_id, feature_name, x, count(*) as n, sum(y) as s
          from (select * from r unpivot (x for feature_name in ({', '.join(features)})))
          group by fold_id, feature_name, x),
    c as (select fold_id, feature_name, x, sum(n) over w as n1, sum(s) over w as s1,
                 sum(n) over (partition by fold_id, feature_name) as n,
                 sum(s) over (partition by fold_id, feature_name) as s
          from v window w as (partition by fold_id, feature_name order by x)),
    g as (select fold_id, feature_name, x, s1 * s1 / n1::double + (s - s1) * (s - s1) / (n - n1)::double as score
          from c where n1 >= 10 and n - n1 >= 10),
    best as (select fold_id, arg_max(feature_name, score) as best, arg_max(x, score) as cut from g group by fold_id)
    """


_STUMP_SQL = f"""{_best_split_sql(_FEW_VALUES)}
    select fold_id, feature_name, cast(feature_name = best as double) as importance
    from (select distinct fold_id, feature_name from v) join best using (fold_id)
"""
SQL["stump_gain_by_fold"] = _STUMP_SQL
SQL["stump_split_by_fold"] = _STUMP_SQL
SQL["stump_noise_selection"] = f"""{_best_split_sql([*_FEW_VALUES, "noise_feature"])}
    select feature_name, count(*) filter (feature_name = best) / 3.0 >= 0.6 as kept
    from (select distinct feature_name from v where feature_name <> 'noise_feature'), best
    group by feature_name
"""

_VALUE = "case best " + " ".join(f"when '{{0}}{c}' then {{0}}{c}" for c in _FEW_VALUES) + " end"
_SHUFFLED = ", ".join(f"coalesce(lead({c}) over w, first_value({c}) over w) as p_{c}" for c in _FEW_VALUES)
_TWO_VALUED_AUC = "0.5 * (1 + avg({0}::int) filter (y = 1) - avg({0}::int) filter (y = 0))"
SQL["stump_permutation"] = f"""{_best_split_sql(_FEW_VALUES)},
    held as (
        select cast({hash_sql(LINE_KEY_TEXT, 'fold42')} % 3 as int) as fold_id,
               cast(l_quantity > 25 or (l_discount > 0.07 and l_linenumber < 3) as int) as y,
               {', '.join(_FEW_VALUES)}, {_SHUFFLED}
        from lineitem where {hash_sql(LINE_KEY_TEXT, 'split42')} < 0.3 * 4294967296
        window w as (partition by {hash_sql(LINE_KEY_TEXT, 'fold42')} % 3
                     order by {hash_sql(LINE_KEY_TEXT, 'permute42:0')}, {', '.join(LINE_KEY)})),
    scored as (select fold_id, y, {_VALUE.format('')} > cut as hi, {_VALUE.replace("'{0}", "'").format('p_')} > cut as p_hi
               from held join best using (fold_id)),
    lost as (select fold_id, {_TWO_VALUED_AUC.format('hi')} - {_TWO_VALUED_AUC.format('p_hi')} as d
             from scored group by fold_id)
    select fold_id, feature_name, round(case when feature_name = best then d else 0 end, 9) as permutation_importance,
           cast(case when feature_name = best then d else 0 end > 0.001 as int) as is_above_threshold
    from (select distinct fold_id, feature_name from v) join best using (fold_id) join lost using (fold_id)
"""



def _date_round_sql(k: int, features: str) -> str:
    """The stumps of one round over the dates, and their AUC on the held-out rows."""
    return f"""
    v{k} as (select fold_id, feature_name, x, count(*) as n, sum(y) as s
             from (select fold_id, y, year, month, day from o where fitted)
                  unpivot (x for feature_name in ({features}))
             group by fold_id, feature_name, x),
    c{k} as (select fold_id, feature_name, x, sum(n) over w as n1, sum(s) over w as s1,
                    sum(n) over (partition by fold_id, feature_name) as n,
                    sum(s) over (partition by fold_id, feature_name) as s
             from v{k} window w as (partition by fold_id, feature_name order by x)),
    g{k} as (select *, s1 * s1 / n1::double + (s - s1) * (s - s1) / (n - n1)::double as score,
                    (s - s1) * n1 > s1 * (n - n1) as up
             from c{k} where n1 >= 20 and n - n1 >= 20),
    best{k} as (select fold_id, arg_max(feature_name, score) as best, arg_max(x, score) as cut,
                       arg_max(up, score) as up from g{k} group by fold_id),
    s{k} as (select fold_id, y,
                    (case best when 'year' then year when 'month' then month else day end > cut) = up as hi
             from o join best{k} using (fold_id) where not fitted),
    a{k} as (select avg(auc) as auc from (
             select fold_id, {_TWO_VALUED_AUC.format('hi')} as auc from s{k} group by fold_id))"""


SQL["stump_adversarial"] = f"""
    with o as (
        select cast({hash_sql('o_orderkey', 'fold42')} % 3 as int) as fold_id,
               {hash_sql('o_orderkey', 'split42')} >= 0.5 * 4294967296 as fitted,
               cast(o_orderdate >= timestamp '1996-06-01 00:00:00' as int) as y,
               year(o_orderdate) as year, month(o_orderdate) as month, day(o_orderdate) as day
        from orders),
    {_date_round_sql(1, 'year, month, day')}, {_date_round_sql(2, 'month, day')}
    select cast(0 as int) as step, (select mode(best) from best1) as feature,
           round(a1.auc - a2.auc, 9) as delta, round(a2.auc, 9) as metric
    from a1, a2 where a1.auc > 0.7
"""

ROUNDS = 3
_BOOSTED = replace(_STUMP, rounds=ROUNDS, learning_rate=0.5)


def _boosted(spark, folder, **changes):
    frame = fold_frame(_planted(spark, folder), _FEW_VALUES, "y", LINE_KEY, 3)
    return frame, fit_folds(frame, _FEW_VALUES, BINARY, replace(_BOOSTED, **changes))


def stump_prefix_scores(spark, folder):
    """Log loss of every prefix of three stumps on the held-out rows, and the rounds that patience keeps."""
    frame, models = _boosted(spark, folder)
    _, cut = _boosted(spark, folder, early_stopping_rounds=2)
    held_out = frame.df.filter(F.col(IS_TRAIN) == 0)
    scored = running_margins(held_out, load_forests(frame, models), values_of(frame, _FEW_VALUES), LABEL)
    sign = 2 * F.col("label") - 1
    each = scored.select(FOLD, sign.alias("sign"), F.posexplode("margins").alias("k", "margin"))
    loss = 2 * F.log1p(F.exp(-2 * F.col("sign") * F.col("margin")))
    kept = spark.createDataFrame([(k, m.getNumTrees) for k, m in cut.items()], f"{FOLD} int, kept int")
    errors = each.groupBy(FOLD, (F.col("k") + 1).alias("rounds")).agg(F.round(F.avg(loss), 9).alias("error"))
    return errors.join(F.broadcast(kept), FOLD).select(FOLD, "rounds", "error", "kept")


def stump_contributions(spark, folder):
    """Mean absolute contributions of each feature to the margin of three stumps, by fold."""
    frame, models = _boosted(spark, folder)
    table_ = contribution_importance(frame, _FEW_VALUES, models)
    return table_.select(FOLD, "feature_name", F.round("importance", 9).alias("importance"))


def stump_mean_contribution(spark, folder):
    frame, models = _boosted(spark, folder)
    table_ = mean_importance(contribution_importance(frame, _FEW_VALUES, models))
    return table_.select("feature_name", F.round("importance", 9).alias("importance"))


_SIGN = "case when l_quantity > 25 or (l_discount > 0.07 and l_linenumber < 3) then 1.0::double else -1.0::double end"


def _boosting_sql(features, rounds: int, rate: float) -> str:
    """Stumps fitted one after the other to the slope of the log loss; rows carry margin and contributions.

    Of round k: m{k} is the margin, d{k} its change by the stump, p{k} the feature it splits on.
    """
    value = "case best " + " ".join(f"when '{c}' then {c}" for c in features) + " end"
    sql = f"""
    with rows0 as (
        select cast({hash_sql(LINE_KEY_TEXT, 'fold42')} % 3 as int) as fold_id,
               {hash_sql(LINE_KEY_TEXT, 'split42')} >= 0.3 * 4294967296 as fitted, {_SIGN} as y, 0.0::double as m0,
               l_quantity, l_discount, l_tax, cast(l_linenumber as double) as l_linenumber from lineitem)"""
    for k in range(1, rounds + 1):
        slope = "y" if k == 1 else f"4 * y / (1 + exp(2 * y * m{k - 1}))"
        sql += f""",
    v{k} as (select fold_id, feature_name, x, count(*) as n, sum(r) as s
             from (select fold_id, {slope} as r, {', '.join(features)} from rows{k - 1} where fitted)
                  unpivot (x for feature_name in ({', '.join(features)}))
             group by fold_id, feature_name, x),
    c{k} as (select fold_id, feature_name, x, sum(n) over w as n1, sum(s) over w as s1,
                    sum(n) over (partition by fold_id, feature_name) as n,
                    sum(s) over (partition by fold_id, feature_name) as s
             from v{k} window w as (partition by fold_id, feature_name order by x)),
    g{k} as (select *, s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) as score from c{k} where n1 >= 5 and n - n1 >= 5),
    best{k} as (select fold_id, arg_max(feature_name, score) as best, arg_max(x, score) as cut, max(s / n) as root,
                       arg_max(s1 / n1, score) as lo, arg_max((s - s1) / (n - n1), score) as hi from g{k} group by fold_id),
    rows{k} as (select rows{k - 1}.*, best as p{k}, m{k - 1} + {1.0 if k == 1 else rate} * leaf as m{k},
                       {1.0 if k == 1 else rate} * (leaf - root) as d{k}
                from (select rows{k - 1}.*, best, root, case when {value} <= cut then lo else hi end as leaf
                      from rows{k - 1} join best{k} using (fold_id)) as rows{k - 1})""".replace(
            f"select rows{k - 1}.*, best as p{k}", f"select * exclude (best, root, leaf), best as p{k}"
        )
    return sql


_THREE = _boosting_sql(_FEW_VALUES, ROUNDS, 0.5)
SQL["stump_prefix_scores"] = f"""{_THREE},
    e as ({' union all '.join(
        f"select fold_id, {k} as rounds, avg(2 * ln(1 + exp(-2 * y * m{k}))) as error from rows{ROUNDS} where not fitted group by fold_id"
        for k in range(1, ROUNDS + 1)
    )}),
    kept as (select fold_id, cast(arg_min(rounds, error) as int) as kept from e group by fold_id)
    select fold_id, rounds, round(error, 9) as error, kept from e join kept using (fold_id)
"""
_CREDIT = " + ".join(f"case when p{k} = feature_name then d{k} else 0 end" for k in range(1, ROUNDS + 1))
_BY_FOLD = f"""{_THREE},
    names as (select unnest({_FEW_VALUES}) as feature_name),
    by_fold as (select fold_id, feature_name, avg(abs({_CREDIT})) as importance
                from rows{ROUNDS}, names where not fitted group by fold_id, feature_name)"""
SQL["stump_contributions"] = f"{_BY_FOLD} select fold_id, feature_name, round(importance, 9) as importance from by_fold"
SQL["stump_mean_contribution"] = f"""{_BY_FOLD}
    select feature_name, round(avg(importance), 9) as importance from by_fold group by feature_name
"""


def stump_forward(spark, folder):
    """Forward selection by stumps: the steps with their mean AUC, the folds that improved, and the verdicts."""
    lines = _planted(spark, folder)
    roles = classify(lines.select(*LINE_KEY[:1], *_FEW_VALUES, "y"), "l_orderkey", "y")
    settings = ForwardSettings(
        cv_folds_importances=3, cv_folds_selection=3, num_boost_round_importances=1, num_boost_round_selection=1,
        max_depth=1, valid_frac=0.3, row_fraction=1.0, feature_fraction=1.0, selection_row_fraction=1.0,
        selection_feature_fraction=1.0,
    )
    result = select_forward(Splits(lines), roles, _FEW_VALUES, settings, "binary_classification", LINE_KEY)
    return result.reports["steps"].withColumn("mean_score", F.round("mean_score", 9))


def _forward_sql() -> str:
    """Every feature's stump and its AUC per fold; a set of features has the AUC of its best stump."""
    sql = f"""
    with o as (
        select cast({hash_sql(LINE_KEY_TEXT, 'fold0')} % 3 as int) as fold_id,
               {hash_sql(LINE_KEY_TEXT, 'split0')} >= 0.3 * 4294967296 as fitted,
               cast(l_quantity > 25 or (l_discount > 0.07 and l_linenumber < 3) as int) as y,
               l_quantity, l_discount, l_tax, cast(l_linenumber as double) as l_linenumber from lineitem),
    u as (select * from o unpivot (x for feature_name in ({', '.join(_FEW_VALUES)}))),
    v as (select fold_id, feature_name, x, count(*) as n, sum(y) as s from u where fitted group by all),
    c as (select fold_id, feature_name, x, sum(n) over w as n1, sum(s) over w as s1,
                 sum(n) over (partition by fold_id, feature_name) as n, sum(s) over (partition by fold_id, feature_name) as s
          from v window w as (partition by fold_id, feature_name order by x)),
    g as (select *, s1 * s1 / n1::double + (s - s1) * (s - s1) / (n - n1)::double as score,
                 (s - s1) * n1 > s1 * (n - n1) as up from c where n1 < n),
    one as (select fold_id, feature_name, max(score) as score, arg_max(x, score) as cut, arg_max(up, score) as up
            from g group by all),
    a as (select fold_id, feature_name, score, {_TWO_VALUED_AUC.format('((x > cut) = up)')} as auc
          from u join one using (fold_id, feature_name) where not fitted group by all),
    ranked as (select feature_name, row_number() over (order by avg(cast(score = top as int)) desc, feature_name) as k
               from (select *, max(score) over (partition by fold_id) as top from a) group by feature_name),
    done0 as (select []::varchar[] as chosen, 0.0::double as mean, [0.0, 0.0, 0.0]::double[] as folds)"""
    for k in range(1, len(_FEW_VALUES) + 1):
        sql += f""",
    try{k} as (select list_append(chosen, feature_name) as tried, feature_name as candidate, mean as before, folds as olds
               from done{k - 1}, ranked where k = {k}),
    auc{k} as (select list(auc order by fold_id) as news from (
               select fold_id, arg_max(auc, score) as auc from a, try{k} where list_contains(tried, feature_name) group by fold_id)),
    step{k} as (select {k - 1} as step, candidate as feature_name, list_avg(news) as mean_score,
                       cast(len(list_filter([1, 2, 3], lambda i: news[i] > olds[i])) as int) as better_folds,
                       better_folds >= 2 and list_avg(news) > before + 1e-4 as accepted, news, tried from try{k}, auc{k}),
    done{k} as (select case when accepted then tried else chosen end as chosen,
                       case when accepted then mean_score else mean end as mean,
                       case when accepted then news else folds end as folds from step{k}, done{k - 1})"""
    steps = " union all ".join(f"select * from step{k}" for k in range(1, len(_FEW_VALUES) + 1))
    return f"{sql} select step, feature_name, round(mean_score, 9) as mean_score, better_folds, accepted from ({steps})"


SQL["stump_forward"] = _forward_sql()


def stump_correlated_removal(spark, folder):
    """The whole correlation step: stumps give the scores, of two correlated features the weaker one goes."""
    lines = _planted(spark, folder).withColumns(
        {"rough_quantity": F.floor(F.col("l_quantity") / 3).cast("double"), "double_tax": 2 * F.col("l_tax")}
    )
    features = [*_FEW_VALUES, "rough_quantity", "double_tax"]
    roles = classify(lines.select(*LINE_KEY[:1], *features, "y"), "l_orderkey", "y")
    stumps = {"n_partitions": 3, "num_boost_round": 1, "max_depth": 1, "row_fraction": 1.0, "feature_fraction": 1.0}
    splits = Splits(lines)
    settings = CorrelationSettings(threshold=0.95, importances=stumps)
    return _verdict(drop_correlated(splits, roles, features, settings, "binary_classification", LINE_KEY), splits, features)


_COPIED = [*_FEW_VALUES, "rough_quantity", "double_tax"]
SQL["stump_correlated_removal"] = f"""
    with o as (
        select cast({hash_sql(LINE_KEY_TEXT, 'fold1')} % 3 as int) as fold_id,
               cast(l_quantity > 25 or (l_discount > 0.07 and l_linenumber < 3) as int) as y,
               l_quantity, l_discount, l_tax, cast(l_linenumber as double) as l_linenumber,
               cast(floor(l_quantity / 3) as double) as rough_quantity, 2 * l_tax as double_tax from lineitem),
    v as (select fold_id, feature_name, x, count(*) as n, sum(y) as s
          from (select * from o unpivot (x for feature_name in ({', '.join(_COPIED)}))) group by all),
    c as (select fold_id, feature_name, x, sum(n) over w as n1, sum(s) over w as s1,
                 sum(n) over (partition by fold_id, feature_name) as n, sum(s) over (partition by fold_id, feature_name) as s
          from v window w as (partition by fold_id, feature_name order by x)),
    g as (select *, s1 * s1 / n1::double + (s - s1) * (s - s1) / (n - n1)::double as score from c where n1 >= 10 and n - n1 >= 10),
    best as (select fold_id, arg_max(feature_name, score) as best from g group by fold_id),
    scores as (select name, avg(cast(name = best as int)) as score from (select unnest({_COPIED}) as name), best group by name),
    pairs as ({' union all '.join(
        f"select '{a}' as f1, '{b}' as f2, corr({a}, {b}) as r from o" for a, b in combinations(sorted(_COPIED), 2)
    )}),
    losers as (select case when a.score < b.score then f1 else f2 end as name
               from pairs join scores a on f1 = a.name join scores b on f2 = b.name where abs(r) >= 0.95)
    select name as feature_name, name not in (select name from losers) as kept from scores
"""


def fold_report_read_back(spark, folder):
    """The fold report that a permutation step writes as CSV, read from its files."""
    report = stump_permutation(spark, folder)
    path = scratch_path(spark, "report")
    write_report(report, path, "csv")
    shape = "fold_id int, feature_name string, permutation_importance double, is_above_threshold int"
    return spark.read.option("header", True).schema(shape).csv(path)


SQL["fold_report_read_back"] = SQL["stump_permutation"]


def removal_history_read_back(spark, folder):
    """The JSON history that the adversarial selector rewrites after each round, read from its files."""
    path = scratch_path(spark, "history")
    _stump_adversarial(spark, folder, history_path=path)
    history = spark.read.schema(HISTORY_SCHEMA).json(path)
    return history.withColumns({c: F.round(c, 9) for c in ("delta", "metric")})


SQL["removal_history_read_back"] = SQL["stump_adversarial"]

QUERIES.update(
    {
        f.__name__: f
        for f in (
            stump_gain_by_fold,
            stump_split_by_fold,
            stump_noise_selection,
            stump_permutation,
            stump_adversarial,
            stump_prefix_scores,
            stump_contributions,
            stump_mean_contribution,
            stump_forward,
            stump_correlated_removal,
            fold_report_read_back,
            removal_history_read_back,
            linear_contribution_by_feature,
            gain_importance_by_fold,
            split_importance_by_fold,
            mean_contribution_by_feature,
            noise_selection,
            permutation_selection,
            forward_selection,
            adversarial_removal,
            correlated_removal,
        )
    }
)
