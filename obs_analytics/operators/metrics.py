"""Model evaluation as distributed aggregates.

Input is a scored frame with a model name, the label and the prediction.
Each metric family is one aggregate over the scored rows; everything after
that works on a handful of rows per model (at most 36 confusion cells).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classes import class_label, value_class
from ..functions.labels import grade
from ..schema import (ACCURACY_GRADES, CLASS_CUTS, CLASS_LABELS, F1_GRADES, FEATURES,
                      LABEL, MAPE_EPSILON, MAPE_GRADES, R2_GRADES, TOLERANCE)

MODEL = "MODEL"


def model_order(names) -> Column:
    """1-based position of MODEL in ``names`` (0 when absent): the tie-break
    that lets the first-listed model win ties, as the reference's strict
    comparison does."""
    return F.array_position(F.array(*[F.lit(n) for n in names]), F.col(MODEL)).cast("int")


def regression_metrics(scored: DataFrame, label: str = LABEL, prediction: str = "prediction",
                       n_features: int = len(FEATURES), by=(MODEL,), tolerance: float = TOLERANCE,
                       epsilon: float = MAPE_EPSILON) -> DataFrame:
    """M7 + M9: RMSE, MSE, MAE, R2, adjusted R2, MAPE (%), tolerance accuracy (%).

    R2 = 1 - MSE / var_pop(label); a constant label gives 1 for a perfect
    prediction and 0 otherwise. Adjusted R2 is null when n - k - 1 = 0.
    MAPE divides by label + epsilon; an exact zero there gives null, not an
    error. The tolerance flag is cast to double before averaging.

    Every metric is over the pairs whose label and prediction are both
    present and not NaN; N_ROWS counts those pairs, N_SKIPPED the others.
    """
    whole = (F.col(label).isNotNull() & F.col(prediction).isNotNull()
             & ~F.isnan(F.col(label).cast("double")) & ~F.isnan(F.col(prediction).cast("double")))
    y, p = F.when(whole, F.col(label)), F.when(whole, F.col(prediction))
    e = y - p
    agg = scored.groupBy(*by).agg(
        F.count(F.when(whole, 1)).alias("N_ROWS"),
        F.count(F.when(~whole, 1)).alias("N_SKIPPED"),
        F.avg(e * e).alias("MSE"),
        F.avg(F.abs(e)).alias("MAE"),
        F.var_pop(y).alias("_var"),
        (F.avg(F.abs(F.try_divide(e, y + F.lit(epsilon)))) * 100).alias("MAPE"),
        (F.avg((F.abs(e) <= F.lit(tolerance)).cast("double")) * 100).alias("TOLERANCE_ACCURACY"))
    r2 = (F.when(F.col("_var") == 0, F.when(F.col("MSE") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(1 - F.col("MSE") / F.col("_var")))
    n = F.col("N_ROWS")
    adj = 1 - (1 - F.col("R2")) * F.try_divide((n - 1).cast("double"),
                                              (n - n_features - 1).cast("double"))
    return (agg.withColumn("R2", r2).withColumn("ADJ_R2", adj)
            .select(*by, "N_ROWS", "N_SKIPPED", F.sqrt("MSE").alias("RMSE"), "MSE", "MAE", "R2", "ADJ_R2",
                    "MAPE", "TOLERANCE_ACCURACY"))


def confusion_counts(scored: DataFrame, label: str = LABEL, prediction: str = "prediction",
                     by=(MODEL,), cuts=CLASS_CUTS) -> DataFrame:
    """Counts per (model, true class, predicted class); rows whose label or
    prediction has no class (null / NaN) are left out."""
    return (scored.select(*by, value_class(label, cuts).alias("TRUE_CLASS"),
                          value_class(prediction, cuts).alias("PRED_CLASS"))
            .filter(F.col("TRUE_CLASS").isNotNull() & F.col("PRED_CLASS").isNotNull())
            .groupBy(*by, "TRUE_CLASS", "PRED_CLASS").agg(F.count(F.lit(1)).alias("COUNT")))


def class_metrics_per_class(scored: DataFrame = None, label: str = LABEL,
                            prediction: str = "prediction", by=(MODEL,), cuts=CLASS_CUTS,
                            labels=CLASS_LABELS, confusion: DataFrame | None = None) -> DataFrame:
    """Precision, recall and F1 of every class, 0 where undefined.

    F1 = 2 TP / (predicted + support), which equals 2PR / (P + R) whenever
    that is defined. Every class is listed for every model.

    One chain: each confusion cell (at most 36 per model) is spread over the
    class list, adding its count to the support of its true class, to the
    predictions of its predicted class, and to TP when the two agree; a sum
    per (model, class) then gives all three. No join, so the scored rows
    are aggregated once.
    """
    cc = confusion if confusion is not None else confusion_counts(scored, label, prediction, by, cuts)
    by = list(by)
    n_classes = len(cuts) + 1
    cls = F.explode(F.sequence(F.lit(0), F.lit(n_classes - 1))).alias("CLASS")
    spread = cc.select(*by, "TRUE_CLASS", "PRED_CLASS", "COUNT", cls)
    t, p, c, n = F.col("TRUE_CLASS"), F.col("PRED_CLASS"), F.col("CLASS"), F.col("COUNT")
    sums = spread.groupBy(*by, "CLASS").agg(
        F.sum(F.when(t == c, n).otherwise(0)).alias("SUPPORT"),
        F.sum(F.when(p == c, n).otherwise(0)).alias("PREDICTED"),
        F.sum(F.when((t == c) & (p == c), n).otherwise(0)).alias("TP"))
    tp = F.col("TP").cast("double")
    sup, pred = F.col("SUPPORT"), F.col("PREDICTED")
    zero = F.lit(0.0)
    return sums.select(
        *by, F.col("CLASS").cast("int").alias("CLASS"), class_label("CLASS", labels).alias("CLASS_LABEL"),
        F.coalesce(F.try_divide(tp, pred.cast("double")), zero).alias("PRECISION"),
        F.coalesce(F.try_divide(tp, sup.cast("double")), zero).alias("RECALL"),
        F.coalesce(F.try_divide(2 * tp, (pred + sup).cast("double")), zero).alias("F1"),
        sup.cast("long").alias("SUPPORT"), pred.cast("long").alias("PREDICTED"),
        F.col("TP").cast("long").alias("TP"))


def class_metrics(scored: DataFrame = None, label: str = LABEL, prediction: str = "prediction",
                  by=(MODEL,), cuts=CLASS_CUTS, per_class: DataFrame | None = None) -> DataFrame:
    """M8: accuracy and support-weighted precision, recall and F1 (fractions).

    A class that is predicted but never true has weight 0. Weighted recall
    equals accuracy by algebra.
    """
    pc = per_class if per_class is not None else class_metrics_per_class(scored, label, prediction, by, cuts)
    n = F.sum("SUPPORT").cast("double")
    w = F.col("SUPPORT").cast("double")
    return pc.groupBy(*by).agg(
        F.try_divide(F.sum("TP").cast("double"), n).alias("ACCURACY"),
        F.try_divide(F.sum(F.col("PRECISION") * w), n).alias("PRECISION"),
        F.try_divide(F.sum(F.col("RECALL") * w), n).alias("RECALL"),
        F.try_divide(F.sum(F.col("F1") * w), n).alias("F1"))


def evaluation_cells(scored: DataFrame, label: str = LABEL, prediction: str = "prediction", by=(MODEL,),
                     cuts=CLASS_CUTS, tolerance: float = TOLERANCE, epsilon: float = MAPE_EPSILON) -> DataFrame:
    """One aggregate over the scored rows for all metrics: per (model, true
    class, predicted class) the count, the error sums and the label's mean and
    spread. At most 36 cells per model; pairs with a missing or NaN side are
    left out."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    whole = y.isNotNull() & p.isNotNull() & ~F.isnan(y) & ~F.isnan(p)
    e = F.abs(y - p)
    ape = F.abs(F.try_divide(y - p, y + F.lit(epsilon)))
    rows = scored.filter(whole).withColumns({
        "TRUE_CLASS": value_class(label, cuts), "PRED_CLASS": value_class(prediction, cuts)})
    return rows.groupBy(*by, "TRUE_CLASS", "PRED_CLASS").agg(
        F.count(F.lit(1)).alias("COUNT"), F.sum(e * e).alias("SQ"), F.sum(e).alias("AB"),
        F.sum(ape).alias("APE"), F.count(ape).alias("N_APE"),
        F.count(F.when(e <= tolerance, 1)).alias("NEAR"), F.avg(y).alias("MEAN"), F.var_pop(y).alias("VAR"))


def comparison_from_cells(cells: DataFrame, names, n_features: int = len(FEATURES),
                          cuts=CLASS_CUTS) -> DataFrame:
    """M11 from ``evaluation_cells``: the cells of a model (36 at most) are
    gathered into one row, and every metric is arithmetic on them, so the
    scored rows are read and aggregated once."""
    own = cells.groupBy(MODEL).agg(F.collect_list(F.struct(
        "TRUE_CLASS", "PRED_CLASS", "COUNT", "SQ", "AB", "APE", "N_APE", "NEAR", "MEAN", "VAR")).alias("c"))

    def total(value, when=lambda x: F.lit(True)):
        return F.aggregate("c", F.lit(0.0), lambda acc, x: acc + F.when(when(x), F.coalesce(value(x).cast("double"), F.lit(0.0))).otherwise(0.0))

    def per_class(value):
        return sum((value(F.lit(k)) for k in range(1, len(cuts) + 1)), value(F.lit(0)))

    n = total(lambda x: x["COUNT"])
    base = own.withColumns({"n": n, "near": total(lambda x: x["NEAR"]), "sq": total(lambda x: x["SQ"]),
                            "ab": total(lambda x: x["AB"]), "ape": total(lambda x: x["APE"]),
                            "n_ape": total(lambda x: x["N_APE"]),
                            "hit": total(lambda x: x["COUNT"], lambda x: x["TRUE_CLASS"] == x["PRED_CLASS"]),
                            "mean": total(lambda x: x["COUNT"] * x["MEAN"]) / n})
    spread = total(lambda x: x["COUNT"] * (x["VAR"] + (x["MEAN"] - F.col("mean")) * (x["MEAN"] - F.col("mean")))) / F.col("n")
    tp = lambda k: total(lambda x: x["COUNT"], lambda x: (x["TRUE_CLASS"] == k) & (x["PRED_CLASS"] == k))
    true = lambda k: total(lambda x: x["COUNT"], lambda x: x["TRUE_CLASS"] == k)
    said = lambda k: total(lambda x: x["COUNT"], lambda x: x["PRED_CLASS"] == k)
    or0 = lambda v: F.coalesce(v, F.lit(0.0))
    precision = per_class(lambda k: true(k) * or0(F.try_divide(tp(k), said(k))))
    f1 = per_class(lambda k: true(k) * or0(F.try_divide(2 * tp(k), said(k) + true(k))))
    mse, var = F.col("sq") / F.col("n"), F.col("var")
    # a constant label leaves rounding noise where its spread should be 0
    flat = var <= F.lit(1e-24) * F.greatest(F.lit(1.0), F.col("mean") * F.col("mean"))
    r2 = F.when(flat, F.when(mse == 0, 1.0).otherwise(0.0)).otherwise(1 - mse / var)
    adjusted = 1 - (1 - F.col("R2")) * F.try_divide(F.col("n") - 1, F.col("n") - n_features - 1)
    return base.withColumn("var", spread).withColumn("R2", r2).select(
        MODEL, model_order(names).alias("MODEL_ORDER"), F.substring(MODEL, 1, 15).alias("MODEL_SHORT"),
        F.sqrt(mse).alias("RMSE"), (F.col("ab") / F.col("n")).alias("MAE"), "R2", adjusted.alias("ADJ_R2"),
        (F.try_divide(F.col("ape"), F.col("n_ape")) * 100).alias("MAPE"),
        (F.col("hit") / F.col("n")).alias("ACCURACY"), (precision / F.col("n")).alias("PRECISION"),
        (F.col("hit") / F.col("n")).alias("RECALL"), (f1 / F.col("n")).alias("F1"),
        (F.col("near") / F.col("n") * 100).alias("TOLERANCE_ACCURACY"), F.col("n").cast("long").alias("N_ROWS"))


def model_comparison(scored: DataFrame, names, label: str = LABEL,
                     prediction: str = "prediction", n_features: int = len(FEATURES)) -> DataFrame:
    """One row per model with the nine compared metrics (plus tolerance
    accuracy), in the given model order. MODEL_SHORT is the name cut to 15
    characters (E13)."""
    return comparison_from_cells(evaluation_cells(scored, label, prediction), names, n_features)


def best_model(comparison: DataFrame, metric: str = "R2") -> DataFrame:
    """O2: the model with the highest R2; the first-listed wins a tie. A null or
    NaN never wins."""
    value = _comparable(F.col(metric))
    key = F.when(value.isNotNull(), F.struct(value.alias("v"), (-F.col("MODEL_ORDER")).alias("o")))
    return comparison.agg(F.max_by(MODEL, key).alias("BEST_MODEL"),
                          F.max(value).alias(f"BEST_{metric}"))


def _comparable(value: Column) -> Column:
    """The value, null where it is NaN (Spark orders NaN above every number)."""
    return F.when(~F.isnan(value.cast("double")), value)


def best_by_metric(comparison: DataFrame, metrics=("R2", "ACCURACY", "F1")) -> DataFrame:
    """O3: the best model for each of R2, accuracy and F1 (first wins ties)."""
    pairs = ", ".join(f"'{m}', CAST({m} AS DOUBLE)" for m in metrics)
    long = comparison.selectExpr(MODEL, "MODEL_ORDER", f"stack({len(metrics)}, {pairs}) AS (METRIC, VALUE)")
    value = _comparable(F.col("VALUE"))
    key = F.when(value.isNotNull(), F.struct(value.alias("v"), (-F.col("MODEL_ORDER")).alias("o")))
    return long.groupBy("METRIC").agg(F.max_by(MODEL, key).alias("BEST_MODEL"),
                                      F.max(value).alias("BEST_VALUE"))


def model_grades(comparison: DataFrame) -> DataFrame:
    """The report's quality grades of each model."""
    return _graded(comparison, [MODEL, "R2", "ACCURACY", "F1", "MAPE"])


def model_report(comparison: DataFrame, metric: str = "R2") -> DataFrame:
    """R2: the winner's ten metrics with their grades. The winner is picked
    among the comparison's few rows, so the comparison is computed once."""
    value = _comparable(F.col(metric))
    first = F.row_number().over(Window.orderBy(value.desc_nulls_last(), "MODEL_ORDER"))  # one row per model
    won = comparison.withColumn("_place", F.when(value.isNotNull(), first)).filter("_place = 1")
    return _graded(won, [MODEL, "RMSE", "MAE", "R2", "ADJ_R2", "MAPE", "ACCURACY", "PRECISION", "RECALL",
                         "F1", "TOLERANCE_ACCURACY"])


def _graded(comparison: DataFrame, columns: list[str]) -> DataFrame:
    return comparison.select(
        *columns,
        grade("R2", R2_GRADES, "Moderate").alias("R2_GRADE"),
        grade("ACCURACY", ACCURACY_GRADES, "Moderate").alias("ACCURACY_GRADE"),
        grade("F1", F1_GRADES, "Moderate").alias("F1_GRADE"),
        grade("MAPE", MAPE_GRADES, "Acceptable", higher_is_better=False).alias("MAPE_GRADE"))
