"""Published outputs: table writes, BI exports, retention list, serving bundle, build log and catalogue."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import exprs as X
from tallyline.plans import analytics, churn, clustering, scoring
from tallyline.schemas import RETENTION_COLUMNS
from tallyline.sources.lake import Scratch, is_complete

# Tables of the BI export, and those left out of its CSV form.
BI_TABLES = ["dim_date", "dim_customer", "dim_product", "dim_country", "fact_transactions", "mart_rfm", "mart_kpi_monthly",
             "mart_features", "mart_churn_scores", "mart_monitoring"]
CSV_EXCLUDED = {"mart_features", "mart_monitoring"}


def publish(df: DataFrame, path: str) -> None:
    """Replace a published table."""
    df.write.mode("overwrite").parquet(path)


def publish_or_view(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """A node of the build: a written table if it has a path, else a temporary view that Catalyst inlines."""
    if path is None:
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    publish(df, path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.createOrReplaceTempView(name)
    return written


def export_for_bi(spark: SparkSession, gold: str, out: str, fmt: str = "parquet") -> DataFrame:
    """Export every gold table that exists to a folder per table. Returns (table_name, status, rows).

    Rows are counted from the exported files.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError("fmt must be 'parquet' or 'csv'")
    rows = []
    for name in BI_TABLES:
        if fmt == "csv" and name in CSV_EXCLUDED:
            rows.append((name, "excluded", None))
        elif not is_complete(spark, f"{gold}/{name}"):
            rows.append((name, "missing", None))
        else:
            df, target = spark.read.parquet(f"{gold}/{name}"), f"{out}/{name}"
            if fmt == "csv":
                df.write.mode("overwrite").option("header", True).csv(target)
                count = spark.read.option("header", True).csv(target).count()
            else:
                df.write.mode("overwrite").parquet(target)
                count = spark.read.parquet(target).count()
            rows.append((name, "exported", count))
    return spark.createDataFrame(rows, "table_name string, status string, rows bigint")


def export_retention_list(retention: DataFrame, path: str) -> None:
    """CSV with a header, highest probability first: files are range-sorted, not gathered into one task."""
    missing = [c for c in RETENTION_COLUMNS if c not in retention.columns]
    if missing:
        raise ValueError(f"retention list lacks {', '.join(missing)}")
    (retention.select(RETENTION_COLUMNS).orderBy(F.desc("churn_probability"), "customer_id")
              .write.mode("overwrite").option("header", True).csv(path))


def read_retention_list(spark: SparkSession, path: str) -> DataFrame:
    schema = ("customer_id string, segment string, churn_probability double, risk_tier string, recency_days int, "
              "frequency bigint, monetary double")
    return spark.read.schema(schema).option("header", True).csv(path)


def retention_acceptance(customers: DataFrame, path: str, threshold: float, **filters) -> dict:
    """Build, check, export and re-read the list; report its size and the revenue at stake."""
    issues: list[str] = []
    missing = [c for c in ("churn_probability", "monetary") if c not in customers.columns]
    if filters.get("segments") and "segment" not in customers.columns:
        missing.append("segment")
    if missing:
        return {"issues": [f"missing column {c}" for c in missing], "metrics": {}, "passed": False}
    chosen = analytics.retention_list(customers, threshold, **filters)
    found = scoring.retention_issues(chosen, customers).filter("rows > 0").collect()
    issues += [f"{r['rule']}: {r['rows']}" for r in found]
    metrics = {}
    if not any(i.startswith("missing") for i in issues):
        export_retention_list(chosen, path)
        totals = chosen.agg(F.count(F.lit(1)).alias("n"), X.exact_sum("monetary").alias("revenue")).first()
        if read_retention_list(customers.sparkSession, path).count() != totals["n"]:
            issues.append("rows differ after re-reading")
        metrics = {"retention_list_size": float(totals["n"]), "revenue_at_stake": totals["revenue"]}
    return {"issues": issues, "metrics": metrics, "passed": not issues}


def serving_base(features: DataFrame, rfm: DataFrame, model: PipelineModel | churn.BoostedModel, cluster_model: PipelineModel | None = None,
                 cluster_names: DataFrame | None = None) -> DataFrame:
    """Features, segment, churn probability and, if a cluster model is stored, the cluster of every customer."""
    base = churn.probabilities(model, features.join(rfm.select("customer_id", "segment"), "customer_id", "left"))
    if cluster_model is None:
        return base
    return base.join(clustering.assign_stored(cluster_model, features, cluster_names), "customer_id", "left")


def named_profiles(profiles: DataFrame, names: DataFrame) -> DataFrame:
    return profiles.join(F.broadcast(names), "cluster_id", "left").withColumn(
        "cluster_name", F.coalesce("cluster_name", F.lit("Unknown")))


def write_serving_bundle(out: str, base: DataFrame, threshold: float, scratch: Scratch, profiles: DataFrame | None = None,
                         monitoring: DataFrame | None = None) -> None:
    """Customers, score summary, and cluster profiles and metric history where they exist."""
    publish(base, f"{out}/customers")
    stored = base.sparkSession.read.parquet(f"{out}/customers")
    publish(scoring.score_summary(stored, threshold, scratch).withColumn("threshold", F.lit(threshold)), f"{out}/score_summary")
    if profiles is not None:
        publish(profiles, f"{out}/cluster_profiles")
    if monitoring is not None:
        publish(monitoring, f"{out}/monitoring")


def build_log(silver: DataFrame, fact: DataFrame, rfm: DataFrame, **dimensions: DataFrame) -> DataFrame:
    """(measure, value): row counts of the build, fact rows without customer key, members per segment."""
    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("measure"), "value")

    out = rows(silver, "silver_rows").unionByName(rows(fact, "fact_transactions_rows")).unionByName(rows(rfm, "mart_rfm_customers"))
    for name, dim in dimensions.items():
        out = out.unionByName(rows(dim, f"{name}_rows"))
    nulls = fact.agg(X.count_if(F.col("customer_sk").isNull()).alias("value")).select(
        F.lit("fact_null_customer_sk").alias("measure"), "value")
    segments = rfm.groupBy("segment").agg(F.count(F.lit(1)).alias("value")).select(
        F.concat(F.lit("segment: "), "segment").alias("measure"), "value")
    return out.unionByName(nulls).unionByName(segments)


def table_catalogue(**tables: DataFrame) -> DataFrame:
    """(table_name, rows, columns, column_list) per table."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("columns"),
            F.lit(", ".join(df.columns)).alias("column_list"))
        out = part if out is None else out.unionByName(part)
    return out


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """A random share of the rows, each kept or not on its own (the row count varies around the share)."""
    return df.sample(fraction=fraction, seed=seed)
