"""Two MLlib models and the model registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import models
from ledgerloom.plans.registry import query, table, total
from ledgerloom.session import scratch_path


# All components of the table's vectors; the SQL is made from the same list.
FEATURES = [f"x{i}" for i in range(64)]


def _classes(spark, d):
    """Vectors with their label; every component is a feature."""
    vectors = table(spark, d, "embeddings")
    parts = [F.col("embedding")[i].cast("double").alias(x) for i, x in enumerate(FEATURES)]
    return vectors.select("vec_id", *parts, F.concat(F.lit("class"), F.col("label").cast("string")).alias("species"))


SCORE = " + ".join(f"(-0.5 * ln(2 * pi() * v{i}) - pow({x} - m{i}, 2) / (2 * v{i}))" for i, x in enumerate(FEATURES))
BAYES = f"""
    WITH e AS (SELECT vec_id, 'class' || label AS species,
      {', '.join(f'embedding[{i + 1}]::DOUBLE AS {x}' for i, x in enumerate(FEATURES))} FROM embeddings),
    fit AS (SELECT species AS k, ln(count(*)) AS prior, {', '.join(f'avg({x}) AS m{i}, var_pop({x}) AS v{i}' for i, x in enumerate(FEATURES))}
      FROM e GROUP BY 1),
    scored AS (SELECT vec_id, species, k, row_number() OVER (PARTITION BY vec_id ORDER BY prior + {SCORE} DESC) AS rk FROM e CROSS JOIN fit)
"""


@query("ml_naive_bayes", BAYES + "SELECT vec_id, species, k AS predicted FROM scored WHERE rk = 1 AND k <> species")
def ml_naive_bayes(spark, d):
    """The misclassified rows."""
    data = _classes(spark, d)
    model = models.fit_naive_bayes(data, FEATURES, "species")
    return models.predict_label(model, data).filter("species <> predicted").select("vec_id", "species", "predicted")


@query(
    "ml_linear",
    """
    WITH m AS (SELECT l_returnflag AS g, avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM lineitem GROUP BY 1),
    s AS (SELECT sum((l_quantity - mx) * (l_extendedprice - my)) / sum((l_quantity - mx) * (l_quantity - mx)) AS slope
          FROM lineitem JOIN m ON l_returnflag = g)
    SELECT l_returnflag, l_quantity, count(*) AS n_rows, round(my + slope * (l_quantity - mx), 2) AS predicted
    FROM lineitem JOIN m ON l_returnflag = g CROSS JOIN s GROUP BY l_returnflag, l_quantity, my, slope, mx
    """,
)
def ml_linear(spark, d):
    data = table(spark, d, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice")
    model = models.fit_linear(data, ["l_quantity"], "l_returnflag", "l_extendedprice")
    # The prediction depends on two columns only: score each combination once.
    cases = data.groupBy("l_returnflag", "l_quantity").agg(total().alias("n_rows"))
    return models.predict_value(model, cases).withColumn("predicted", F.round("predicted", 2))


@query("ml_registry", BAYES + "SELECT species, k AS predicted, count(*) AS n_rows FROM scored WHERE rk = 1 GROUP BY 1, 2")
def ml_registry(spark, d):
    """Fit, store under a name, load the latest version, score."""
    root = scratch_path(spark, "models")
    data = _classes(spark, d)
    model = models.fit_naive_bayes(data, FEATURES, "species")
    models.save_model(spark, model, root, "species", 1)
    scored = models.predict_label(models.load_model(spark, root, "species"), data)
    return scored.groupBy("species", "predicted").agg(total().alias("n_rows"))
