"""Checks of result files: findings as rows (severity, rule, n, examples), from raw lines, so malformed rows show."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kithlink.operators.metrics import duplicate_ids, macro_f05
from kithlink.operators.resolve import truth_pairs
from kithlink.sources.tsv import exists, match_targets, read_ids

FINDING = "severity string, rule string, n long, examples array<string>"
# Headers of the strict files.
MATCHING_HEADER, CANDIDATE_HEADER = ["source1_entity_id", "matched_entity_ids"], ["source1_entity_id", "candidate_entity_ids"]
EXAMPLES = 5


def _finding(spark: SparkSession, rule: str, n: int = 1, examples: list[str] | None = None, severity: str = "error") -> DataFrame:
    return spark.createDataFrame([(severity, rule, n, examples or [])], FINDING)


def _offenders(rows: DataFrame, column: str, rule: str, severity: str = "error") -> DataFrame:
    """One finding with the number of distinct offenders and the first of them; no row if there is none."""
    names = rows.select(F.col(column).alias("x")).distinct()
    first = names.orderBy("x").limit(EXAMPLES).agg(F.sort_array(F.collect_list("x")).alias("examples"))
    return names.agg(F.count(F.lit(1)).alias("n")).filter("n > 0").crossJoin(first).select(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), "n", "examples")  # one row each


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def parsed_lines(lines: DataFrame) -> DataFrame:
    """value -> source1_id, ids (array), and whether the line has no tab; line: its number (the header is not among them)."""
    cut = F.split("value", "\t", 2)
    rest = F.try_element_at(cut, F.lit(2))
    ids = F.when(F.trim(F.coalesce(rest, F.lit(""))) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ","))
    return lines.select("line", "value", cut[0].alias("source1_id"), rest.isNull().alias("no_tab"), ids.alias("ids"))


def id_list_findings(rows: DataFrame, required: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """Findings of parsed rows of a strict file against the required entities (id) and, if given, the valid ids (id)."""
    good = rows.filter(~F.col("no_tab"))
    each = good.select("source1_id", F.explode("ids").alias("id"))
    seen = good.select(F.col("source1_id").alias("id")).distinct()
    parts = [
        _offenders(rows.filter(F.col("no_tab") & (F.trim("value") != "")).select(F.col("line").cast("string").alias("line")), "line", "row without tab"),
        _offenders(duplicate_ids(good, "source1_id"), "source1_id", "duplicate row"),
        _offenders(good.filter(F.size("ids") != F.size(F.array_distinct("ids"))), "source1_id", "repeated id in a list"),
        _offenders(each.filter(F.col("id").startswith("S1-")), "id", "self match"),
        _offenders(each.filter(~F.col("id").startswith("S1-") & ~F.col("id").startswith("S2-") & ~F.col("id").startswith("S3-")), "id", "wrong prefix"),
        _offenders(required.select("id").join(seen, "id", "left_anti"), "id", "missing entity"),
        _offenders(seen.join(required.select("id"), "id", "left_anti"), "id", "unknown entity"),
    ]
    if valid is not None:
        others = each.filter(F.col("id").startswith("S2-") | F.col("id").startswith("S3-"))
        parts.append(_offenders(others.join(valid.select("id"), "id", "left_anti"), "id", "unknown id"))
    return _union(parts)


def _read(spark: SparkSession, path: str, header: list[str]) -> tuple[DataFrame | None, DataFrame | None]:
    """(parsed rows, None), or (None, the finding that ends the check)."""
    if not exists(spark, path):
        return None, _finding(spark, "missing file", examples=[path])
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), "value")
    top = lines.orderBy("line").first()
    if top is None:
        return None, _finding(spark, "empty file", examples=[path])
    if not lines.filter(~F.is_valid_utf8("value")).isEmpty():
        return None, _finding(spark, "not UTF-8", examples=[path])
    if "\t" not in top["value"] and "," in top["value"]:
        return None, _finding(spark, "comma-separated header", examples=[top["value"]])
    if [c.strip().lower() for c in top["value"].split("\t")] != header:
        return None, _finding(spark, "unexpected header", examples=[top["value"]])
    return parsed_lines(lines.filter(F.col("line") != top["line"]).withColumn("line", F.col("line") + 1)), None


def validate_strict(spark: SparkSession, matching: str, test_folder: str, candidates: str | None = None, check_ids: bool = False) -> DataFrame:
    """Matching file, and candidate file if there is one, against the test split. Warnings don't fail a file."""
    required = read_ids(spark, f"{test_folder}/test_source1.tsv")
    parts, valid = [], None
    if check_ids:
        valid = match_targets(spark, test_folder)
        if valid is None:
            parts.append(_finding(spark, "no files to check ids against", severity="warning"))
    else:
        parts.append(_finding(spark, "ids not checked", severity="warning"))
    rows, failed = _read(spark, matching, MATCHING_HEADER)
    parts.append(failed if rows is None else id_list_findings(rows, required, valid))
    if candidates is None or not exists(spark, candidates):
        parts.append(_finding(spark, "no candidate file", severity="warning"))
    else:
        others, failed = _read(spark, candidates, CANDIDATE_HEADER)
        parts.append(failed if others is None else id_list_findings(others, required, valid))
        if rows is not None and others is not None:
            parts.append(not_among_candidates(rows, others))
    return _union(parts)


def not_among_candidates(matching: DataFrame, candidates: DataFrame) -> DataFrame:
    """A warning with the entities that have a match which isn't among their candidates."""
    pairs = lambda df: df.select("source1_id", F.explode("ids").alias("id")).distinct()
    return _offenders(pairs(matching).join(pairs(candidates), ["source1_id", "id"], "left_anti"), "source1_id", "match not among candidates", "warning")


def counters(results: DataFrame) -> DataFrame:
    """rows, empty, non_empty, total_matched of (source1_id, matched_ids)."""
    ids = F.when(F.trim(F.coalesce("matched_ids", F.lit(""))) == "", 0).otherwise(F.size(F.split("matched_ids", ",")))
    empty = (ids == 0).cast("long")
    return results.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(empty), F.lit(0)).alias("empty"), F.coalesce(F.sum(1 - empty), F.lit(0)).alias("non_empty"), F.coalesce(F.sum(ids), F.lit(0)).cast("long").alias("total_matched"))


def validate_results(results: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """The pipeline's own rules for (source1_id, matched_ids): header, repeated rows, blank items; with the truth also coverage, as warnings."""
    spark = results.sparkSession
    if results.columns != ["source1_id", "matched_ids"]:
        return _finding(spark, "unexpected header", examples=results.columns)
    blank = results.filter((F.coalesce("matched_ids", F.lit("")) != "") & F.exists(F.split("matched_ids", ","), lambda x: F.trim(x) == ""))
    parts = [_offenders(duplicate_ids(results, "source1_id"), "source1_id", "duplicate row"), _offenders(blank, "source1_id", "blank id in a list")]
    if truth is not None:
        parts.append(_offenders(truth.join(results, "source1_id", "left_anti"), "source1_id", "missing entity", "warning"))
        parts.append(_offenders(results.join(truth, "source1_id", "left_anti"), "source1_id", "unknown entity", "warning"))
    return _union(parts)


def score_results(results: DataFrame, truth: DataFrame) -> DataFrame:
    """Macro F0.5 of a results table against a truth table, both (source1_id, matched_ids)."""
    return macro_f05(truth_pairs(truth), truth_pairs(results), truth.select("source1_id"))


def passes(findings: DataFrame) -> bool:
    return findings.filter("severity = 'error'").isEmpty()
