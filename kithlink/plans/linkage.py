"""The linkage as a whole: block, compare, train, predict, evaluate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kithlink.operators import blocking, metrics, resolve
from kithlink.operators.features import feature_matrix, fit_vocabularies, with_tfidf
from kithlink.operators.models import BalancedLogistic, Ensemble
from kithlink.operators.neighbours import nearest
from kithlink.sources import tsv


@dataclass
class Linkage:
    """Train and predict over records (source, id, row, name, address[, vector])."""

    profile: str = "main"
    config: dict = field(default_factory=dict)
    model: Ensemble | BalancedLogistic | None = None
    threshold: float = 0.5
    #: TF-IDF vocabularies of the training records, by field; kept for prediction, as features of other vocabularies don't fit the model.
    vocabularies: dict[str, DataFrame] | None = None

    @property
    def blocking(self) -> dict:
        return self.config.get("blocking", {})

    def candidates(self, records: DataFrame) -> DataFrame:
        """Always of the given records; with a vector column also their nearest neighbours."""
        k = self.blocking.get("max_candidates_per_source1", blocking.MAX_CANDIDATES)
        known = {c: v for c, v in self.blocking.items() if c in blocking.DEFAULTS}
        if self.profile == "evaluate" or "vector" not in records.columns or not self.blocking.get("use_embedding_blocking", True):
            return blocking.block(records, self.profile, k, known).select("source1_id", "candidate_id", "source")
        near = nearest(records.filter("source = 'source1'"), records.filter("source <> 'source1'"), self.blocking.get("neighbours", 60))
        return blocking.block_hybrid(records, near, k, k, self.profile, known).select("source1_id", "candidate_id", "source")

    def matrix(self, pairs: DataFrame, records: DataFrame) -> DataFrame:
        return feature_matrix(pairs, with_tfidf(records, self.profile, vocabularies=self.vocabularies), self.profile)

    def train(self, records: DataFrame, truth: DataFrame, held_out: float | None = None) -> dict:
        """truth: (source1_id, matched_ids). held_out: share of entities kept apart for threshold and metrics; None uses the training pairs, as the main profile does."""
        self.vocabularies = {field: words.persist() for field, words in fit_vocabularies(records, self.profile).items()}
        pairs = resolve.with_labels(self.candidates(records), resolve.truth_pairs(truth))
        labelled = self.matrix(pairs, records).cache()
        fit, test = resolve.split(labelled, 1 - held_out, keys=("source1_id",)) if held_out else (labelled, labelled)
        if self.profile == "main":
            settings = self.config.get("matching", {})
            self.model = Ensemble(settings.get("ensemble_weights")).fit(fit, settings.get("models"), test)
            self.threshold = self.model.threshold
        else:
            self.model = BalancedLogistic().fit(fit)
            best = metrics.best_threshold(self.model.probabilities(test), metrics.threshold_grid(0.05, 0.95, 91)).first()
            self.threshold = best["tau"]
        scored = self.model.probabilities(test).cache()
        out = metrics.binary_metrics(scored, self.threshold).first().asDict()
        out |= metrics.roc_auc(scored).first().asDict() | metrics.average_precision(scored).first().asDict()
        out |= metrics.blocking_recall(resolve.truth_pairs(truth), pairs).select("recall").withColumnRenamed("recall", "blocking_recall").first().asDict()
        scored.unpersist()
        labelled.unpersist()
        return out | {"threshold": self.threshold}

    def scored(self, records: DataFrame) -> DataFrame:
        if self.model is None:
            raise ValueError("train or load a model first")
        return self.model.probabilities(self.matrix(self.candidates(records), records))

    def predict(self, records: DataFrame) -> DataFrame:
        """(source1_id, matched): a row for each reference record."""
        entities = records.filter("source = 'source1'").select(F.col("id").alias("source1_id"))
        return resolve.matches(self.scored(records), self.threshold, entities)

    def save(self, path: str) -> None:
        self.model.save(path)
        spark = SparkSession.getActiveSession()
        for field, words in (self.vocabularies or {}).items():
            words.coalesce(1).write.mode("overwrite").parquet(f"{path}/vocabulary_{field}")  # at most max_features rows
        spark.createDataFrame([(self.profile, float(self.threshold))], "profile string, threshold double").coalesce(1).write.mode("overwrite").parquet(f"{path}/linkage")

    @classmethod
    def load(cls, path: str, config: dict | None = None) -> "Linkage":
        spark = SparkSession.getActiveSession()
        row = spark.read.parquet(f"{path}/linkage").first()
        model = (Ensemble if row["profile"] == "main" else BalancedLogistic).load(path)
        return cls(row["profile"], config or {}, model, row["threshold"], {field: spark.read.parquet(f"{path}/vocabulary_{field}") for field in ("name", "address")})


def evaluate(records: DataFrame, truth: DataFrame, sample: int | None = None, decoys: tuple[int, int] = (500, 50_000)) -> dict:
    """The evaluate profile from records and truth to a macro F0.5: sample, index with decoys, block, compare, fit, search, score."""
    chosen = resolve.stratified_sample(truth, sample) if sample else truth
    true = resolve.truth_pairs(chosen)
    entities = chosen.select("source1_id")
    left = records.filter("source = 'source1'").join(entities.withColumnRenamed("source1_id", "id"), "id", "left_semi")
    right = resolve.decoy_sample(records.filter("source <> 'source1'"), true, *decoys)
    linkage = Linkage("evaluate")
    subset = left.unionByName(right).cache()
    out = linkage.train(subset, chosen, held_out=0.2)
    out |= metrics.macro_f05(true, resolve.truth_pairs(linkage.predict(subset).select("source1_id", F.array_join("matched", ",").alias("matched_ids"))), entities).first().asDict()
    subset.unpersist()
    return out | {"top": linkage.model.coefficients()}


def records_of(spark: SparkSession, folder: str, split: str, order: str = "main") -> tuple[DataFrame, DataFrame | None]:
    found = tsv.load_sources(spark, folder, split, order)
    return blocking.union_sources(found["source1"], found["source2"], found["source3"]), found.get("ground_truth")
