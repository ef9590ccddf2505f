"""Batch steps that read raw tables and write clean, feature and result tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from larder.operators import basket, cleaning, customers, features, menu, peaks, quality, recommend, validation
from larder.sources import readers, schemas, writers


def load_raw(spark: SparkSession, directory: str, fmt: str = "csv") -> dict[str, DataFrame]:
    read = readers.read_table_csv if fmt == "csv" else readers.read_table
    return {table: read(spark, directory, table) for table in schemas.TABLES}


def ingest(spark: SparkSession, raw_dir: str, out_dir: str) -> dict[str, DataFrame]:
    """CSV tables to Parquet; returns the written tables. Broken lines go to quarantine, counts are taken while writing."""
    tables, report = {}, {}
    for name in schemas.TABLES:
        good, broken = readers.read_checked_csv(spark, readers.find_table(spark, raw_dir, name, ("csv",)), schemas.schema(name))
        report[name] = writers.write_measured(good, f"{out_dir}/raw", name)
        report[f"{name} (broken lines)"] = writers.write_measured(broken, f"{out_dir}/quarantine", f"broken_lines_{name}")
        tables[name] = spark.read.parquet(report[name].path)
    writers.write_json(writers.written_report(spark, report), f"{out_dir}/reports/ingestion")
    return tables


def clean(tables: Mapping[str, DataFrame], out_dir: str, max_date: str, extra: bool = True) -> dict[str, DataFrame]:
    """Quality report, cleaning with quarantine and the clean tables."""
    writers.write_json(quality.run_quality(tables, as_of=max_date), f"{out_dir}/reports/quality")

    def stage(df: DataFrame, name: str) -> DataFrame:
        path = writers.write_table(df, f"{out_dir}/steps", name)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    done, _, log = cleaning.run_cleaning(tables, max_date, extra, stage)
    out = {}
    for name, df in done.items():
        path = writers.write_table(df, f"{out_dir}/clean", name)
        out[name] = df.sparkSession.read.parquet(path)
    writers.write_json(log, f"{out_dir}/reports/cleaning")
    writers.write_json(validation.check_clean_layer(tables, out), f"{out_dir}/reports/clean_layer")
    return out


def build_features(tables: Mapping[str, DataFrame], out_dir: str, period_end: str) -> dict[str, DataFrame]:
    built = {
        "item": features.item_features(tables),
        "customer": features.customer_features(tables, period_end),
        "order": features.order_features(tables),
        "location_item": features.location_item_features(tables),
        "time": features.time_features(tables),
    }
    written = {name: writers.write_measured(df, f"{out_dir}/features", f"{name}_features") for name, df in built.items()}
    spark = built["item"].sparkSession
    writers.write_json(writers.written_report(spark, written).withColumnRenamed("table", "feature_table"), f"{out_dir}/reports/features")
    return {name: spark.read.parquet(w.path) for name, w in written.items()}


def build_results(
    tables: Mapping[str, DataFrame], feats: Mapping[str, DataFrame], out_dir: str, half_split: str
) -> dict[str, DataFrame]:
    """Menu classes, difficult cases, rules, peaks, scenarios and recommendations from clean tables and features."""
    orders, lines = tables["Orders"], tables["Order_Items"]
    out: dict[str, DataFrame] = {}

    def save(name: str, build: Callable[[], DataFrame]) -> None:
        df = build()
        out[name] = df.sparkSession.read.schema(df.schema).parquet(writers.write_table(df, f"{out_dir}/results", name))

    days = menu.item_days(orders, lines)
    save("menu_profitability", lambda: menu.menu_profitability(feats["item"], orders, lines, half_split, days))
    save("menu_performance", lambda: menu.menu_performance(out["menu_profitability"]))
    save("tricky_cases", lambda: menu.tricky_cases(out["menu_profitability"], orders, lines, days=days))
    save("slow_moving", lambda: menu.simple_slow_movers(out["menu_performance"]))
    save("location_intelligence", lambda: recommend.location_intelligence(out["tricky_cases"]))
    save("channel_intelligence", lambda: recommend.channel_findings(customers.channel_intelligence(feats["customer"])))
    save(
        "recommendations",
        lambda: recommend.recommendations(out["slow_moving"], out["location_intelligence"], out["channel_intelligence"]),
    )
    save("what_if", lambda: recommend.what_if(feats["item"]))
    save("basket_rules", lambda: basket.name_rules(basket.association_rules(lines), tables["Menu_Items"]))
    save("revenue_by_restaurant", lambda: peaks.revenue_by_restaurant(feats["order"]))
    writers.write_json(recommend.result_counts(out), f"{out_dir}/reports/results")
    return out
