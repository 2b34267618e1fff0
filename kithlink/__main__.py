"""python -m kithlink train|predict|validate|evaluate ..."""

from __future__ import annotations

import argparse
import sys

from kithlink.operators import validate
from kithlink.plans.linkage import Linkage, evaluate, records_of
from kithlink.session import local_session, ship
from kithlink.sources import tsv


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="kithlink")
    parser.add_argument("mode", choices=["train", "predict", "validate", "evaluate"])
    parser.add_argument("--config")
    parser.add_argument("--data-dir", default="data")
    parser.add_argument("--model-dir", default="models")
    parser.add_argument("--output", default="matching_results.tsv")
    parser.add_argument("--candidates", default=None)
    parser.add_argument("--truth")
    parser.add_argument("--profile", choices=["main", "evaluate"], default="main")
    parser.add_argument("--strict", action="store_true", help="validate against the test split in --data-dir")
    parser.add_argument("--check-ids", action="store_true")
    parser.add_argument("--sample", type=int)
    given = parser.parse_args(args)
    spark = ship(local_session())
    config = tsv.load_config(given.config) if given.config else {}
    if given.mode == "train":
        records, truth = records_of(spark, given.data_dir, "train")
        linkage = Linkage(given.profile, config)
        print(linkage.train(records, truth))
        linkage.save(given.model_dir)
    elif given.mode == "predict":
        records, _ = records_of(spark, given.data_dir, "test")
        linkage = Linkage.load(given.model_dir, config)
        if given.candidates:
            tsv.write_candidates(linkage.candidates(records), given.candidates)
        tsv.write_results(linkage.predict(records), given.output)
    elif given.mode == "evaluate":
        print(evaluate(*records_of(spark, given.data_dir, "train", "evaluate"), sample=given.sample))
    else:
        if given.strict:
            findings = validate.validate_strict(spark, given.output, given.data_dir, given.candidates, given.check_ids)
        else:
            truth = tsv.read_truth(spark, given.truth) if given.truth else None
            results = tsv.read_tsv(spark, given.output)
            findings = validate.validate_results(results, truth)
            if truth is not None:
                validate.score_results(results, truth).show()
        findings.show(truncate=False)
        return 0 if validate.passes(findings) else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
