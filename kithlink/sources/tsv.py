"""Tab-separated files: sources, truth, candidates, results; and the configuration."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column names of either style.
RECORD_ALIASES = {"entity_id": "id", "business_name": "name", "business_address": "address"}
TRUTH_ALIASES = {"source1_entity_id": "source1_id", "matched_entity_ids": "matched_ids"}
RECORD_COLUMNS, TRUTH_COLUMNS = ["id", "name", "address"], ["source1_id", "matched_ids"]


def read_tsv(spark: SparkSession, path: str, **options) -> DataFrame:
    """All columns as strings, doubled quotes inside quotes, empty fields as ''. Options override the reader's.

    Quoted fields may hold line ends, so a file is one task; with multiLine=False, for files without such fields, large files are split.
    """
    chosen = {"sep": "\t", "header": True, "inferSchema": False, "quote": '"', "escape": '"', "multiLine": True, "mode": "FAILFAST"} | options
    return spark.read.options(**chosen).csv(path).na.fill("")


def _single(df: DataFrame, path: str) -> None:
    """One part under the wanted name: for small results that others read as a file."""
    spark = df.sparkSession
    folder = f"{path}.parts"
    df.coalesce(1).write.mode("overwrite").options(sep="\t", header=True, emptyValue="", quote='"', escape='"').csv(folder)
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(folder)) if s.getPath().getName().startswith("part-"))
    if target.getParent() is not None:
        fs.mkdirs(target.getParent())
    fs.delete(target, False)
    fs.rename(part, target)
    fs.delete(jvm.org.apache.hadoop.fs.Path(folder), True)


def write_tsv(df: DataFrame, path: str, single: bool = True) -> None:
    """With a header; a file, or a folder of parts for results too large for one task. Missing folders are made."""
    if single:
        _single(df, path)
    else:
        df.write.mode("overwrite").options(sep="\t", header=True, emptyValue="", quote='"', escape='"').csv(path)


def _renamed(df: DataFrame, aliases: dict[str, str], columns: list[str]) -> DataFrame:
    df = df.withColumnsRenamed(aliases)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*columns)


def read_source(spark: SparkSession, path: str, **options) -> DataFrame:
    """id, name, address, under either set of names; others are dropped, a missing one is an error."""
    return _renamed(read_tsv(spark, path, **options), RECORD_ALIASES, RECORD_COLUMNS)


def read_truth(spark: SparkSession, path: str, **options) -> DataFrame:
    return _renamed(read_tsv(spark, path, **options), TRUTH_ALIASES, TRUTH_COLUMNS)


def numbered(records: DataFrame) -> DataFrame:
    """records with `row`, which orders them as they were read."""
    return records.withColumn("row", F.monotonically_increasing_id())


def write_candidates(pairs: DataFrame, path: str, single: bool = True) -> None:
    write_tsv(pairs.select("source1_id", "candidate_id", "source"), path, single)


def write_candidate_lists(pairs: DataFrame, entities: DataFrame, path: str, single: bool = True) -> None:
    """The style of the strict validator: a row for each entity with its candidates."""
    lists = pairs.groupBy("source1_id").agg(F.sort_array(F.collect_set("candidate_id")).alias("c"))
    done = entities.select("source1_id").distinct().join(lists, "source1_id", "left")
    write_tsv(done.select(F.col("source1_id").alias("source1_entity_id"), F.coalesce(F.array_join("c", ","), F.lit("")).alias("candidate_entity_ids")), path, single)


def write_results(matched: DataFrame, path: str, style: str = "pipeline", single: bool = True) -> None:
    """matched: (source1_id, matched array). style "strict" has the names that the strict validator expects."""
    names = ["source1_id", "matched_ids"] if style == "pipeline" else ["source1_entity_id", "matched_entity_ids"]
    write_tsv(matched.select(F.col("source1_id").alias(names[0]), F.array_join("matched", ",").alias(names[1])), path, single)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def find(spark: SparkSession, folder: str, names: list[str]) -> str | None:
    """The first of the names that the folder has."""
    return next((f"{folder}/{n}" for n in names if exists(spark, f"{folder}/{n}")), None)


def load_sources(spark: SparkSession, folder: str, split: str = "train", order: str = "main", **options) -> dict[str, DataFrame]:
    """source1..3, and ground_truth for the train split, as far as they are there; main skips missing files, evaluate raises. Options are the reader's."""
    found: dict[str, DataFrame] = {}
    for i in (1, 2, 3):
        names = [f"source{i}_{split}.tsv", f"{split}_source{i}.tsv"]
        path = find(spark, folder, names if order == "main" else names[::-1])
        if path:
            found[f"source{i}"] = numbered(read_source(spark, path, **options))
        elif order == "evaluate":
            raise FileNotFoundError(f"no file for source{i} in {folder}")
    if split == "train":
        names = [f"ground_truth_{split}.tsv", f"{split}_ground_truth.tsv"]
        path = find(spark, folder, names if order == "main" else names[::-1])
        if path:
            found["ground_truth"] = read_truth(spark, path, **options)
        elif order == "evaluate":
            raise FileNotFoundError(f"no truth in {folder}")
    return found


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of the first column, trimmed, without the header and blank lines."""
    first = F.trim(F.element_at(F.split("value", "\t"), 1))
    lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id())
    return lines.filter("at <> 0").select(first.alias("id")).filter("id <> ''").distinct()


def match_targets(spark: SparkSession, folder: str) -> DataFrame | None:
    """Ids of both other sources of the test split; None if a file is missing."""
    paths = [f"{folder}/test_source{i}.tsv" for i in (2, 3)]
    if not all(exists(spark, p) for p in paths):
        return None
    return read_ids(spark, paths[0]).union(read_ids(spark, paths[1])).distinct()


def load_config(path: str) -> dict:
    """A YAML or JSON file as a dictionary."""
    with open(path, encoding="utf-8") as file:
        if path.endswith(".json"):
            return json.load(file)
        import yaml

        return yaml.safe_load(file) or {}
