"""Queries for splits, folds and samplers."""

from __future__ import annotations

from pyspark.sql import functions as F

from gable.functions import domain as D
from gable.operators import prep as P
from gable.operators import reduce, samplers, splits
from gable.plans.property_view import UNITS_SQL, property_rows, table, units, with_sql
from gable.plans.registry import query


def _order(seed, key):
    return f"md5('{seed}|' || CAST({key} AS VARCHAR)), {key}"


@query(
    "split_shuffle",
    "I1",
    f"""SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {_order(0, 'o_orderkey')}) <= ceil(0.2 * count(*) OVER ())
    THEN 'test' ELSE 'train' END AS split FROM orders""",
)
def split_shuffle(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey")
    return splits.split_data(rows, "regression", "o_orderkey")


@query(
    "split_stratified",
    "I1 I3",
    f"""SELECT event_id, event_type, CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY {_order(3, 'event_id')})
    <= round(0.2 * count(*) OVER (PARTITION BY event_type)) THEN 'test' ELSE 'train' END AS split FROM events""",
)
def split_stratified(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    return splits.split_data(rows, "multiclass", "event_id", "event_type", seed=3)


@query(
    "split_ordered",
    "I1 I2",
    """SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) > count(*) OVER () - ceil(0.25 * count(*) OVER ())
    THEN 'test' ELSE 'train' END AS split FROM events""",
)
def split_ordered(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts")
    return splits.training_validation_split(rows, "event_id", order=["ts", "event_id"]).drop("ts")


@query(
    "split_timeseries",
    "I4",
    """WITH p AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS t, count(*) OVER () AS n FROM events),
    s AS (SELECT *, n // 4 AS size, n - (3 - split_id) * (n // 4) AS first_test FROM p, (SELECT unnest([0, 1, 2]) AS split_id))
    SELECT event_id, split_id, 'train' AS role FROM s WHERE t < least(first_test + 2, n)
    UNION ALL SELECT event_id, split_id, 'test' FROM s WHERE t >= first_test - 3 AND t < least(first_test + size + 2, n)""",
)
def split_timeseries(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts")
    return splits.time_series_split(rows, ["ts", "event_id"], n_splits=3, max_delay=3, gap=2).drop("ts")


@query(
    "kfold_stratified",
    "I5",
    f"""SELECT event_id, event_type, CAST((row_number() OVER (PARTITION BY event_type ORDER BY {_order(5, 'event_id')}) - 1) % 4 AS INTEGER) AS fold
    FROM events""",
)
def kfold_stratified(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    return splits.k_fold(rows, "event_id", 4, ["event_type"], seed=5)


@query(
    "kfold_plain",
    "I6",
    f"SELECT o_orderkey, CAST((row_number() OVER (ORDER BY {_order(0, 'o_orderkey')}) - 1) % 3 AS INTEGER) AS fold FROM orders",
)
def kfold_plain(spark, sf_dir):
    return splits.k_fold(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 3)


@query(
    "split_prepared",
    "I15 B7 B10 F6",
    with_sql(
        UNITS_SQL
        + f""", one AS (SELECT * FROM units WHERE price_p BETWEEN (SELECT quantile_cont(price_p, 0.01) FROM units)
          AND (SELECT quantile_cont(price_p, 0.99) FROM units)),
        two AS (SELECT * FROM one WHERE price_p BETWEEN 10000 AND (SELECT quantile_cont(price_p, 0.99) FROM one)
          AND rooms < 10 AND area < 800 AND area > 0),
        aside AS (SELECT *, row_number() OVER (PARTITION BY postcode_area ORDER BY {_order(0, 'unit_indx')})
          <= round(0.15 * count(*) OVER (PARTITION BY postcode_area)) AS v FROM two),
        rest AS (SELECT * FROM aside WHERE NOT v AND area IS NOT NULL QUALIFY count(*) OVER (PARTITION BY key) > 5)""",
        f"""SELECT unit_indx, 'validate' AS split FROM aside WHERE v
        UNION ALL SELECT unit_indx, CASE WHEN row_number() OVER (PARTITION BY key ORDER BY {_order(1, 'unit_indx')})
          <= round(0.15 * count(*) OVER (PARTITION BY key)) THEN 'test' ELSE 'train' END FROM rest""",
    ),
)
def split_prepared(spark, sf_dir):
    rows = P.prepare_and_split(P.raw_rows(property_rows(spark, sf_dir)))
    return rows.select("unit_indx", "split")


_GOALS = """sizes AS (SELECT toxic, count(*) AS n FROM labels GROUP BY toxic),
least AS (SELECT min(n) AS m, sum(n) AS total FROM sizes),
goals AS (SELECT toxic, n, CASE WHEN n * 1.0 / m > 4 AND NOT ((SELECT min(n) FROM sizes) < 20 AND (SELECT min(n) * 1.0 / sum(n) FROM sizes) < 0.1)
  THEN greatest(4 * m, 20) ELSE n END AS goal FROM sizes, least)"""


@query(
    "balance_sampler",
    "I7 I13",
    with_sql(
        _GOALS,
        f"""SELECT l.doc_id, l.toxic FROM labels l JOIN goals g ON l.toxic = g.toxic
        QUALIFY row_number() OVER (PARTITION BY l.toxic ORDER BY {_order(0, 'l.doc_id')}) <= any_value(g.goal) OVER (PARTITION BY l.toxic)""",
    ),
)
def balance_sampler(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    sampler = samplers.BalancedClassificationSampler(balanced_ratio=4, min_samples=20)
    return sampler.fit_resample(rows, "toxic", "doc_id")


_SPLIT = f"""split AS (SELECT doc_id, toxic, row_number() OVER (ORDER BY {_order(2, 'doc_id')}) <= ceil(0.25 * count(*) OVER ()) AS t FROM labels),
kept AS (SELECT * FROM split WHERE NOT t QUALIFY row_number() OVER (PARTITION BY toxic ORDER BY {_order(0, 'doc_id')})
  <= (SELECT min(n) FROM (SELECT count(*) AS n FROM split WHERE NOT t GROUP BY toxic)))"""


@query(
    "balanced_split",
    "I8 I9 I13",
    with_sql(_SPLIT, "SELECT doc_id, toxic, 'test' AS split FROM split WHERE t UNION ALL SELECT doc_id, toxic, 'train' FROM kept"),
)
def balanced_split(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return samplers.resampled_split(rows, samplers.RandomUnderSampler(), "toxic", "doc_id", seed=2)


@query(
    "balanced_folds",
    "I8 I5",
    f"""WITH folds AS (SELECT doc_id, toxic, (row_number() OVER (PARTITION BY toxic ORDER BY {_order(0, 'doc_id')}) - 1) % 3 AS fold FROM labels),
    long AS (SELECT doc_id, toxic, CAST(i AS INTEGER) AS split_id, CASE WHEN fold = i THEN 'test' ELSE 'train' END AS split
      FROM folds, (SELECT unnest([0, 1, 2]) AS i)),
    least AS (SELECT split_id, min(n) AS m FROM (SELECT split_id, toxic, count(*) AS n FROM long WHERE split = 'train' GROUP BY ALL) GROUP BY 1)
    SELECT doc_id, toxic, split_id, split FROM long JOIN least USING (split_id)
    QUALIFY split = 'test' OR row_number() OVER (PARTITION BY split_id, split, toxic ORDER BY {_order(0, 'doc_id')}) <= m""",
)
def balanced_folds(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return samplers.resampled_folds(rows, samplers.RandomUnderSampler(), "toxic", "doc_id", k=3)


@query(
    "under_sampler",
    "I9 I13",
    f"""SELECT doc_id, quality FROM labels QUALIFY row_number() OVER (PARTITION BY quality ORDER BY {_order(0, 'doc_id')})
    <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY quality))""",
)
def under_sampler(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return samplers.RandomUnderSampler().fit_resample(rows, "quality", "doc_id")


@query(
    "under_sampler_replace",
    "I9",
    """WITH sizes AS (SELECT quality, count(*) AS n, min(count(*)) OVER () AS least FROM labels GROUP BY quality),
  draws AS (SELECT quality, n, unnest(range(0, least)) AS draw FROM sizes),
  picks AS (SELECT quality, floor(('0x' || substr(md5('4|' || quality || '|' || draw), 1, 13))::BIGINT / 4503599627370496.0 * n) + 1 AS rank FROM draws),
  ranked AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('4|' || doc_id), doc_id) AS rank FROM labels)
  SELECT doc_id, quality FROM picks JOIN ranked USING (quality, rank)""",
)
def under_sampler_replace(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return samplers.RandomUnderSampler(replacement=True, seed=4).fit_resample(rows, "quality", "doc_id")


def _vectors(spark, sf_dir):
    rows = reduce.spread_array(table(spark, sf_dir, "embeddings"), "embedding", 64, "e")
    # Labels above 6 are rare classes taken together, so that classes differ in size.
    return rows.withColumn("label", F.when(F.col("label") > 6, 1).otherwise(0))


_E64 = [f"e{i}" for i in range(64)]


@query("smote", "I11 I13 I14")
def smote(spark, sf_dir):
    return samplers.SMOTE(5).fit_resample(_vectors(spark, sf_dir), "label", "vec_id", _E64)


@query("smote_tomek", "I11")
def smote_tomek(spark, sf_dir):
    return samplers.SMOTETomek(5).fit_resample(_vectors(spark, sf_dir), "label", "vec_id", _E64)


@query("smote_nc", "I12")
def smote_nc(spark, sf_dir):
    rows = _vectors(spark, sf_dir).withColumn("band", F.when(F.col("e0") > 0, "high").otherwise("low"))
    return samplers.SMOTENC(["band"], 5).fit_resample(rows, "label", "vec_id", [*_E64[1:], "band"])


@query("kmeans_smote", "I10")
def kmeans_smote(spark, sf_dir):
    return samplers.KMeansSMOTE(2, n_clusters=4).fit_resample(_vectors(spark, sf_dir), "label", "vec_id", _E64)


@query(
    "class_sizes_by_key",
    "F6 C8",
    with_sql(UNITS_SQL, "SELECT key, count(*) AS n FROM units GROUP BY key HAVING count(*) > 5"),
)
def class_sizes_by_key(spark, sf_dir):
    rows = units(spark, sf_dir).withColumn("key", D.composite_key("postcode_area", "property_type"))
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 5)
