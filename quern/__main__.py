"""Command line: python -m quern audit | clean | candidates | match | evaluate | validate."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def main(args: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="quern")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, *options: tuple[str, dict]) -> None:
        p = sub.add_parser(name)
        for flag, how in options:
            p.add_argument(flag, **how)

    s1, pool, out = ("--s1", {"required": True}), ("--pool", {"nargs": "+", "required": True}), ("--out", {"required": True})
    profile, policy, fitted = ("--profile", {"default": "evidence"}), ("--policy", {"default": "country"}), ("--model", {})
    command("audit", ("inputs", {"nargs": "+"}))
    command("clean", ("input", {}), out)
    command("candidates", s1, pool, out, profile)
    command("match", s1, pool, out, profile, policy, fitted)
    command("evaluate", s1, pool, ("--truth", {"required": True}), profile, policy, fitted)
    command("validate", ("matches", {}), ("--candidates", {}), s1, ("--pool", {"nargs": "*", "default": []}))
    a = top.parse_args(args)

    from quern.operators import audit, blocking, model, validate
    from quern.operators.normalize import normalize
    from quern.plans import pipeline as run
    from quern.schema import POLICIES, PROFILES
    from quern.sources import tsv

    spark = SparkSession.builder.appName("quern").getOrCreate()
    loaded = model.load(a.model) if getattr(a, "model", None) else None
    if a.command == "audit":
        entities = audit.with_source(*[tsv.read_tsv(spark, p) for p in a.inputs])
        for table in (audit.row_counts, audit.missing, audit.ids, audit.duplicates, audit.country_counts, audit.lengths, audit.quality_flags):
            print(f"\n## {table.__name__}\n" + tsv.markdown(table(entities)))
    elif a.command == "clean":
        tsv.write_tsv(normalize(tsv.read_tsv(spark, a.input)), a.out)
    elif a.command == "candidates":
        queries = run.cleaned(spark, a.s1)
        tsv.write_id_lists(blocking.as_lists(run.candidates(queries, run.cleaned(spark, *a.pool), PROFILES[a.profile]), queries, "candidate_entity_ids"), a.out)
    elif a.command == "match":
        print(json.dumps({"queries": run.match(spark, a.s1, a.pool, a.out, a.profile, a.policy, loaded)}))
    elif a.command == "evaluate":
        print(json.dumps(run.evaluate(run.cleaned(spark, a.s1), run.cleaned(spark, *a.pool), run.truth_pairs(spark, a.truth), PROFILES[a.profile], POLICIES[a.policy], loaded)))
    else:
        targets = run.cleaned(spark, *a.pool) if a.pool else None
        found = validate.validate(spark, a.matches, ("source1_entity_id", "matched_entity_ids"), tsv.read_tsv(spark, a.s1), targets)
        rows = found.collect()
        if a.candidates:
            outside = validate.not_in_candidates(tsv.read_id_lists(spark, a.matches), tsv.read_id_lists(spark, a.candidates)).count()
            print(f"warning: {outside} queries have matches that are no candidates")
        print(tsv.markdown(spark.createDataFrame(rows, found.schema)))
        print(tsv.markdown(validate.summary(tsv.read_id_lists(spark, a.matches)).select(*[F.col(c) for c in ("n_rows", "n_empty", "n_non_empty", "n_ids")])))
        return int(bool(rows))
    return 0


if __name__ == "__main__":
    sys.exit(main())
