"""Working tables derived from the given Parquet tables, with the same SQL text.

The given tables hold no NULL, so missing cells are injected by integer
arithmetic on the row key that both engines evaluate alike. Each ``*_SQL``
constant is a common table expression producing what the function beside it does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabforge.functions.rng import uniform, uniform_sql
from tabforge.plans.catalog import table


def gap(cond_mod: int, limit: int, value: Column, row_id: str = "row_id") -> Column:
    """NULL for the share ``limit`` percent of ids picked by a multiplier."""
    return F.when((F.col(row_id) * cond_mod) % 100 >= limit, value)


# ---- readings: the hourly sensor role, with gaps ---------------------------


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """events as sensor readings: a, c lost together, b mostly lost, h complete."""
    e = table(spark, sf, "events")
    base = e.select(
        F.col("event_id").alias("row_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        F.col("event_type"),
        F.col("value").alias("v"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.hour("ts").cast("double").alias("h"),
        (F.col("user_id") % 4).alias("grp"),
    )
    return base.select(
        "*",
        gap(7919, 21, F.col("v")).alias("a"),
        gap(104729, 59, F.col("v") + F.col("k")).alias("b"),
        gap(7919, 21, F.col("k") * 2.0).alias("c"),
        F.when((F.col("row_id") * 31) % 50 != 0, F.col("event_type")).alias("cat"),
        (F.col("v") + F.col("k") > 100).cast("int").alias("label"),
    )


READINGS_SQL = """readings AS (
  SELECT *, CASE WHEN (row_id * 7919) % 100 >= 21 THEN v END AS a,
    CASE WHEN (row_id * 104729) % 100 >= 59 THEN v + k END AS b,
    CASE WHEN (row_id * 7919) % 100 >= 21 THEN k * 2.0e0 END AS c,
    CASE WHEN (row_id * 31) % 50 <> 0 THEN event_type END AS cat,
    CAST(v + k > 100 AS INTEGER) AS label
  FROM (SELECT event_id AS row_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, event_type, value AS v,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k, CAST(hour(ts) AS DOUBLE) AS h, user_id % 4 AS grp FROM events))"""

GAP_COLUMNS = ["a", "b", "c", "h"]


# ---- scored: a prediction table with forced score ties ---------------------


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """One prediction per event; scores have two decimals, so ties are common."""
    e = table(spark, sf, "events")
    rows = e.select(
        F.col("event_id").alias("row_id"),
        F.col("event_type"),
        F.col("value").alias("y"),
        (F.col("user_id") % 4).alias("grp"),
        F.col("event_type").isin("purchase", "signup").cast("int").alias("label"),
    )
    rows = rows.withColumn("score", F.round(uniform("row_id", 1) * 0.7 + F.col("label") * 0.3, 2))
    return rows.select(
        "*",
        (F.col("score") >= 0.5).cast("int").alias("prediction"),
        (F.col("y") * 0.8 + uniform("row_id", 2) * 20.0).alias("y_hat"),
    )


SCORED_SQL = f"""scored AS (
  SELECT *, CAST(score >= 0.5e0 AS INTEGER) AS prediction, y * 0.8e0 + {uniform_sql('row_id', 2)} * 20.0e0 AS y_hat
  FROM (SELECT *, round({uniform_sql('row_id', 1)} * 0.7e0 + label * 0.3e0, 2) AS score FROM (
    SELECT event_id AS row_id, event_type, value AS y, user_id % 4 AS grp,
      CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS label FROM events)))"""


# ---- runs: a leaderboard measured on the scored table ----------------------

MODEL_NAMES = {
    "click": "Voting (Soft)",
    "error": "Random Forest",
    "purchase": "GridSearch KNN",
    "signup": "Stacking (LR)",
    "view": "Logistic Regression",
}
SCALER_NAMES = ["None", "StandardScaler", "MinMaxScaler", "RobustScaler"]


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Leaderboard rows (model, normalization, metrics), one per slice of the events.

    The label is whether an event's value is large; the 'model' of a slice is named
    after its event type and its 'scaler' after a user group.
    """
    from tabforge.operators.metrics import binary_metrics

    s = scored(spark, sf)
    names = F.create_map(*[F.lit(v) for kv in MODEL_NAMES.items() for v in kv])
    scalers = F.array(*[F.lit(x) for x in SCALER_NAMES])
    rows = s.select(
        names[F.col("event_type")].alias("model"),
        F.get(scalers, F.col("grp").cast("int")).alias("normalization"),
        (F.col("y") > 30).cast("int").alias("label"),
        (F.col("y") + (F.col("score") - 0.5) * 60.0 > 30).cast("int").alias("prediction"),
    )
    out = binary_metrics(rows, by=["model", "normalization"])
    return out.select(
        "model",
        "normalization",
        *[F.round(c, 8).alias(c) for c in ("accuracy", "precision", "recall", "f1_score")],
        F.round((F.col("sensitivity") + F.col("specificity")) / 2, 8).alias("roc_auc"),
        ((F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")) / 100.0).alias("training_time_s"),
    )


_MODEL_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MODEL_NAMES.items()) + " END"
_SCALER_CASE = "CASE grp " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(SCALER_NAMES)) + " END"

RUNS_SQL = (
    SCORED_SQL
    + f""", run_cells AS (
  SELECT {_MODEL_CASE} AS model, {_SCALER_CASE} AS normalization,
    CAST(count(*) FILTER (y > 30 AND p) AS DOUBLE) AS tp, CAST(count(*) FILTER (y > 30 AND NOT p) AS DOUBLE) AS fn,
    CAST(count(*) FILTER (NOT (y > 30) AND p) AS DOUBLE) AS fp, CAST(count(*) FILTER (NOT (y > 30) AND NOT p) AS DOUBLE) AS tn
  FROM (SELECT *, (y + (score - 0.5e0) * 60.0e0 > 30) AS p FROM scored) GROUP BY 1, 2),
runs AS (SELECT model, normalization, round((tp + tn) / (tp + tn + fp + fn), 8) AS accuracy,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 8) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 8) AS recall,
  round(CASE WHEN tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 8) AS f1_score,
  round((CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END + CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END) / 2, 8) AS roc_auc,
  (tp + tn + fp + fn) / 100.0e0 AS training_time_s FROM run_cells)"""
)


def with_sql(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


# ---- parts: integer-valued features with gaps, for neighbour operators -----


def parts(spark: SparkSession, sf: str) -> DataFrame:
    """part with whole-number features (distances are exact) and gaps."""
    p = table(spark, sf, "part").select(
        F.col("p_partkey").alias("row_id"),
        F.col("p_size").cast("double").alias("size0"),
        F.round(F.col("p_retailprice") * 10 - 9000).alias("price0"),
        F.regexp_extract("p_brand", r"(\d+)", 1).cast("double").alias("brand"),
        F.length("p_name").cast("double").alias("name_len"),
    )
    return p.select(
        "*",
        gap(7919, 20, F.col("size0")).alias("size"),
        gap(104729, 30, F.col("price0")).alias("price"),
        (8 * F.col("size0") + 10 * F.col("brand") > 330).cast("int").alias("label"),
    )


PARTS_SQL = """parts AS (
  SELECT *, CASE WHEN (row_id * 7919) % 100 >= 20 THEN size0 END AS size,
    CASE WHEN (row_id * 104729) % 100 >= 30 THEN price0 END AS price,
    CAST(8 * size0 + 10 * brand > 330 AS INTEGER) AS label
  FROM (SELECT p_partkey AS row_id, CAST(p_size AS DOUBLE) AS size0, round(p_retailprice * 10 - 9000) AS price0,
    CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS DOUBLE) AS brand, CAST(length(p_name) AS DOUBLE) AS name_len FROM part))"""
PART_FEATURES = ["size", "price", "brand", "name_len"]
