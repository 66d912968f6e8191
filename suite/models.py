"""Regression."""

from pyspark.sql import functions as F

from assayloom.functions.names import member_flag
from assayloom.operators import layers as N
from assayloom.operators import regress as R
from assayloom.session import spread_scan
from suite.registry import query


def closed_form(source: str, x1: str, x2: str, y: str, reg: str = "0") -> str:
    """One row (b0, b1, b2) of two-feature least squares with an L2 penalty ``reg``."""
    return f"""(SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM (
  SELECT (s2 * c1 - s12 * c2) / (s1 * s2 - s12 * s12) AS b1, (s1 * c2 - s12 * c1) / (s1 * s2 - s12 * s12) AS b2,
    m1, m2, my FROM (
    SELECT VAR_POP({x1}) * COUNT(*) + {reg} AS s1, VAR_POP({x2}) * COUNT(*) + {reg} AS s2,
      COVAR_POP({x1}, {x2}) * COUNT(*) AS s12, COVAR_POP({x1}, {y}) * COUNT(*) AS c1,
      COVAR_POP({x2}, {y}) * COUNT(*) AS c2, AVG({x1}) AS m1, AVG({x2}) AS m2, AVG({y}) AS my FROM {source})))"""


_FIT = closed_form("lineitem", "l_quantity", "l_discount", "l_extendedprice")
_STAGED = f"""src AS (SELECT l_orderkey, l_linenumber, l_extendedprice, b0 + b1 * l_quantity + b2 * l_discount AS base,
  CASE WHEN l_returnflag IN ('A', 'R') THEN 1.0 ELSE 0.0 END AS flag FROM lineitem, {_FIT}),
staged AS (SELECT l_orderkey, l_linenumber, l_extendedprice, base, b0 + b1 * base + b2 * flag AS pred
  FROM src, {closed_form('src', 'base', 'flag', 'l_extendedprice')})"""


@query(f"SELECT ROUND(b0, 2) AS b0, ROUND(b1, 2) AS b1, ROUND(b2, 2) AS b2 FROM {_FIT}")
def linear_regression(t):
    b0, (b1, b2) = R.linear_coefficients(R.fit_linear(t.lineitem, ["l_quantity", "l_discount"], "l_extendedprice"))
    # The model is three numbers; the row count ties the result to the table it was fitted on.
    return t.lineitem.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.round(F.lit(b0), 2).alias("b0"), F.round(F.lit(b1), 2).alias("b1"),
        F.round(F.lit(b2), 2).alias("b2"),
    )


@query(f"""SELECT l_orderkey, l_linenumber, ROUND(b0 + b1 * l_quantity + b2 * l_discount, 2) AS prediction
FROM lineitem, {_FIT}""")
def batch_scoring(t):
    model = R.fit_linear(t.lineitem, ["l_quantity", "l_discount"], "l_extendedprice")
    scored = R.score(model, t.lineitem, ["l_orderkey", "l_linenumber"])
    return scored.withColumn("prediction", F.round("prediction", 2))


def _lines(t):
    wanted = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_returnflag"]
    return spread_scan(t.lineitem.select(*wanted), ["l_orderkey", "l_linenumber"])


def _flagged(t):
    return _lines(t).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice",
        member_flag("l_returnflag", ["A", "R"]).cast("double").alias("flag"),
    )


@query(f"WITH {_STAGED} SELECT l_orderkey, l_linenumber, ROUND(base, 2) AS base_prediction, ROUND(pred, 2) AS prediction FROM staged")
def two_stage_regression(t):
    table = _flagged(t)
    models = R.fit_stacked(table, ["l_quantity", "l_discount"], "flag", "l_extendedprice")
    return R.score_stacked(models, table).select(
        "l_orderkey", "l_linenumber", F.round("base_prediction", 2).alias("base_prediction"),
        F.round("prediction", 2).alias("prediction"),
    )


@query(f"""WITH {_STAGED} SELECT 'base_prediction' AS stage, CAST(0 AS INTEGER) AS epoch,
  ROUND(AVG((base - l_extendedprice) * (base - l_extendedprice)) / 1000000, 4) AS loss FROM staged
UNION ALL SELECT 'prediction', 1, ROUND(AVG((pred - l_extendedprice) * (pred - l_extendedprice)) / 1000000, 4) FROM staged""")
def stage_loss_table(t):
    table = _flagged(t)
    models = R.fit_stacked(table, ["l_quantity", "l_discount"], "flag", "l_extendedprice")
    scored = R.score_stacked(models, table)
    losses = R.stage_losses(scored, "l_extendedprice", ["base_prediction", "prediction"])
    return losses.withColumn("loss", F.round(F.col("loss") / 1000000, 4))


@query()
def optimiser_history(t):
    model = R.fit_linear(t.lineitem, ["l_quantity", "l_discount"], "l_extendedprice", solver="l-bfgs", max_iter=20)
    return R.objective_history(t.spark, "base", model)


@query()
def boosted_regression(t):
    model = R.fit_boosted(_lines(t), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", rounds=5, depth=3)
    return R.score(model, t.lineitem, ["l_orderkey", "l_linenumber"])


_RIDGE = [closed_form("lineitem", "l_quantity", "l_discount", y, "1") for y in ("l_extendedprice", "l_tax")]


def _arrays(t):
    return _lines(t).select(
        "l_orderkey", "l_linenumber",
        F.array("l_quantity", "l_discount").alias("features"), F.array("l_extendedprice", "l_tax").alias("targets"),
    )


@query(f"""SELECT CAST(0 AS INTEGER) AS target, ROUND(b0, 2) AS intercept, ROUND(b1, 2) AS w_quantity, ROUND(b2, 2) AS w_discount FROM {_RIDGE[0]}
UNION ALL SELECT 1, ROUND(b0, 2), ROUND(b1, 2), ROUND(b2, 2) FROM {_RIDGE[1]}""")
def multi_output_ridge(t):
    fitted = R.fit_ridge(_arrays(t), "features", "targets", 1.0)
    return fitted.select(
        "target", F.round("intercept", 2).alias("intercept"), F.round(F.col("coef")[0], 2).alias("w_quantity"),
        F.round(F.col("coef")[1], 2).alias("w_discount"),
    )


@query(f"""SELECT l_orderkey, l_linenumber, CAST(0 AS INTEGER) AS target, ROUND(b0 + b1 * l_quantity + b2 * l_discount, 2) AS prediction
FROM lineitem, {_RIDGE[0]}
UNION ALL SELECT l_orderkey, l_linenumber, 1, ROUND(b0 + b1 * l_quantity + b2 * l_discount, 2) FROM lineitem, {_RIDGE[1]}""")
def multi_output_scoring(t):
    table = _arrays(t)
    scored = R.score_ridge(table, R.fit_ridge(table, "features", "targets", 1.0), "features")
    return scored.select(
        "l_orderkey", "l_linenumber", F.posexplode("prediction").alias("target", "prediction")
    ).withColumn("prediction", F.round("prediction", 2))


_TWO_STAGES = """s AS (SELECT l_quantity AS x, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS f, l_extendedprice AS y FROM lineitem),
c AS (SELECT COUNT(*) AS n, AVG(x) AS mx, AVG(f) AS mf, AVG(y) AS my FROM s),
g AS (SELECT SUM((x - mx) * (x - mx)) AS xx, SUM((x - mx) * (f - mf)) AS xf, SUM((f - mf) * (f - mf)) AS ff,
  SUM((x - mx) * (y - my)) AS xy, SUM((f - mf) * (y - my)) AS fy, SUM((y - my) * (y - my)) AS yy FROM s, c),
b AS (SELECT xy / (xx + 1) AS w FROM g),
k AS (SELECT w, w * w * xx + 1 AS a, w * xf AS b, ff + 1 AS d, w * xy AS p, fy AS q FROM g, b),
v AS (SELECT w, (p * d - b * q) / (a * d - b * b) AS v1, (a * q - b * p) / (a * d - b * b) AS v2 FROM k)"""


@query()
def two_stage_ridge(t):
    table = t.embeddings.select(
        "vec_id", F.slice("embedding", 1, 32).alias("features"), F.slice("embedding", 33, 32).alias("targets"),
        member_flag("label", [0, 1]).alias("flag"),
    )
    models = R.fit_stacked_ridge(table, "features", "flag", "targets", 0.1)
    scored = R.score_stacked_ridge(models, table, "features", "flag")
    return scored.select("vec_id", F.posexplode("prediction").alias("target", "prediction"))


@query(f"""WITH {_STAGED} SELECT CAST(0 AS BIGINT) AS n_rising,
  ROUND(AVG((base - l_extendedprice) * (base - l_extendedprice)) / 1000000, 2) AS last_error FROM staged""")
def optimiser_history_summary(t):
    """Steps at which the loss rose, and the last loss in the label's units: half the error over the label's variance."""
    model = R.fit_linear(_lines(t), ["l_quantity", "l_discount"], "l_extendedprice", solver="l-bfgs", max_iter=100)
    history = R.objective_history(t.spark, "base", model)
    later = history.select((F.col("epoch") - 1).alias("epoch"), F.col("loss").alias("later"))
    rising = history.join(later, "epoch").agg(F.count_if(F.col("later") > F.col("loss") * (1 + 1e-12)).alias("n_rising"))
    last = history.agg(F.max_by("loss", "epoch").alias("last"))
    spread = t.lineitem.agg(F.var_samp("l_extendedprice").alias("variance"))
    return rising.select("n_rising", F.round(2 * last.scalar() * spread.scalar() / 1000000, 2).alias("last_error"))


@query("SELECT COUNT(*) AS n_scored, CAST(0 AS BIGINT) AS n_not_finite, TRUE AS beats_the_mean FROM lineitem")
def boosted_regression_summary(t):
    features = ["l_quantity", "l_discount", "l_tax"]
    model = R.fit_boosted(_lines(t), features, "l_extendedprice", rounds=5, depth=3)
    scored = R.score(model, t.lineitem, ["l_extendedprice"])
    p, y = F.col("prediction"), F.col("l_extendedprice")
    return scored.agg(
        F.count(F.lit(1)).alias("n_scored"), F.count_if(p.isNull() | F.isnan(p) | (F.abs(p) == float("inf"))).alias("n_not_finite"),
        (F.avg((p - y) * (p - y)) < F.var_pop(y)).alias("beats_the_mean"))


def _one_feature(t):
    return _lines(t).select(
        F.array("l_quantity").alias("features"), member_flag("l_returnflag", ["R"]).alias("flag"),
        F.array("l_extendedprice").alias("targets"))


@query(f"""WITH {_TWO_STAGES}
SELECT ROUND(w, 2) AS w_stage_one, ROUND(w * v1, 2) AS w_quantity, ROUND(v2, 2) AS w_flag FROM v""")
def two_stage_ridge_closed_form(t):
    """One feature and one target: stage two is a fit on the stage-one prediction and the flag."""
    table = _one_feature(t)
    base, second = R.fit_stacked_ridge(table, "features", "flag", "targets", 1.0)
    return base.select("target", F.col("coef")[0].alias("w")).join(second.select("target", "coef"), "target").select(
        F.round("w", 2).alias("w_stage_one"), F.round(F.col("coef")[0], 2).alias("w_quantity"),
        F.round(F.col("coef")[1], 2).alias("w_flag"))


@query(f"""WITH {_TWO_STAGES},
l AS (SELECT n, yy, yy - 2 * w * xy + w * w * xx AS base,
  yy - 2 * (w * v1 * xy + v2 * fy) + w * v1 * w * v1 * xx + 2 * w * v1 * v2 * xf + v2 * v2 * ff AS second FROM g, c, v)
SELECT 'base' AS stage, CAST(2 AS BIGINT) AS n_epochs, ROUND(yy / n / 1000000, 4) AS first_loss, ROUND(base / n / 1000000, 4) AS last_loss,
  CAST(0 AS BIGINT) AS n_rising FROM l
UNION ALL SELECT 'prediction', 3, ROUND(yy / n / 1000000, 4), ROUND(second / n / 1000000, 4), 0 FROM l""")
def ridge_losses_by_step(t):
    """Loss by step of both stages: it starts at the variance, never rises and ends at the closed form."""
    _, history = R.fit_ridge_steps(_one_feature(t), "features", "targets", 1.0, "flag")
    later = history.select("stage", (F.col("epoch") - 1).alias("epoch"), F.col("loss").alias("later"))
    return history.join(later, ["stage", "epoch"], "left").groupBy("stage").agg(
        F.count(F.lit(1)).alias("n_epochs"), F.round(F.min_by("loss", "epoch") / 1000000, 4).alias("first_loss"),
        F.round(F.max_by("loss", "epoch") / 1000000, 4).alias("last_loss"),
        F.count_if(F.col("later") > F.col("loss") * (1 + 1e-9)).alias("n_rising"))


@query("""SELECT COUNT(*) AS n_scored, CAST(0 AS BIGINT) AS n_not_finite, CAST(41 AS BIGINT) AS n_epochs, TRUE AS falls,
  TRUE AS beats_the_line FROM lineitem""")
def layered_fit_summary(t):
    """Two stages with hidden layers on a target that bends at half the largest quantity, where a line does little."""
    table = _lines(t).select(
        F.array("l_quantity", "l_discount").alias("features"), member_flag("l_returnflag", ["R"]).cast("double").alias("flag"),
        F.array((F.abs(F.col("l_quantity") - 25) * (1 - F.col("l_discount"))).cast("double")).alias("targets"))
    model, history = N.fit_layers(table, "features", "targets", (16,), "flag", (8,), epochs=40, rate=0.06)
    line = R.score_ridge(table, R.fit_ridge(table, "features", "targets", 0.0), "features", "line")
    scored = N.score_layers(line, model, "features", "flag")
    p, q, y = F.col("prediction")[0], F.col("line")[0], F.col("targets")[0]
    judged = scored.agg(
        F.count(F.lit(1)).alias("n_scored"), F.count_if(p.isNull() | F.isnan(p) | (F.abs(p) == float("inf"))).alias("n_not_finite"),
        (F.avg((p - y) * (p - y)) < 0.5 * F.avg((q - y) * (q - y))).alias("beats_the_line"))
    epochs = history.agg(F.count(F.lit(1)).alias("n"), (F.max_by("loss", "epoch") < 0.5 * F.min_by("loss", "epoch")).alias("falls"))
    return judged.withColumns({"n_epochs": epochs.select("n").scalar(), "falls": epochs.select("falls").scalar()})
