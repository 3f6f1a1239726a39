"""Command line: python -m loomgraph queries | run NAME FOLDER [OUT] | build FOLDER OUT | validate FOLDER | readiness FOLDER | verify RELEASE."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from loomgraph.plans import canon, catalogue
from loomgraph.sources import stores


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="loomgraph")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("queries", help="list the queries")
    for name, extra in (("run", ["name", "folder", "out"]), ("build", ["folder", "out"]), ("validate", ["folder"]), ("readiness", ["folder"]), ("verify", ["release"])):
        p = sub.add_parser(name)
        for a in extra:
            p.add_argument(a, nargs="?" if (name, a) == ("run", "out") else None)
    args = parser.parse_args(argv)
    if args.command == "queries":
        print("\n".join(sorted(catalogue.queries())))
        return 0
    spark = SparkSession.builder.getOrCreate()
    if args.command == "run":
        df = catalogue.queries()[args.name](spark, args.folder)
        df.write.mode("overwrite").parquet(args.out) if args.out else df.show(50, truncate=False)
        return 0
    if args.command == "build":
        tables = {"relations": canon.canonical_relations(spark, args.folder), "entities": canon.canonical_entities(spark, args.folder), "fields": canon.entity_fields(spark, args.folder), "issues": canon.build_issues(spark, args.folder)}
        keys = {"relations": ["relation_id"], "entities": ["canonical_id"], "fields": ["subject_id", "field"], "issues": ["check", "key"]}
        print(stores.write_release(tables, args.out, keys))
        return 0
    if args.command == "verify":
        bad = stores.verify_release(spark, args.release)
        print("ok" if not bad else "differs: " + ", ".join(bad))
        return len(bad)
    name = {"validate": "findings_by_severity", "readiness": "readiness_indicators"}[args.command]
    print(stores.render_table(catalogue.queries()[name](spark, args.folder), args.command))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
