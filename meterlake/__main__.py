"""``python -m meterlake``: run the job or one of its steps, also through spark-submit."""

from __future__ import annotations

import argparse

from meterlake.contracts import base_contracts, read_contracts
from meterlake.functions.months import previous_month
from meterlake.operators.rules import LAYERS, fixed_rule_document, load_rule_document
from meterlake.plans import job, quality_store
from meterlake.session import build_session
from meterlake.sources.tables import Lake


STEPS = ("run", "check-landing", "contracts", "ingest", "full-refresh", "silver", "gold", "quality-setup", "quality")


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="meterlake", description=__doc__)
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--root", required=True, help="shared folder of the stored layers")
    parser.add_argument("--landing", required=True, help="folder of the landing files")
    parser.add_argument("--start-month", required=True, help="first month, yyyy-MM")
    parser.add_argument("--end-month", required=True, help="last month, yyyy-MM, or auto for the previous one")
    parser.add_argument("--passenger-month", help="month of the hourly product, by default the last one")
    parser.add_argument("--contracts", help="folder of contract documents")
    parser.add_argument("--dictionary-texts", help="JSON lines of dataset and text, from which contracts are built")
    parser.add_argument("--services", help="services to read again in full, comma-separated; by default all")
    parser.add_argument("--rules", help="rules file, JSON or YAML")
    parser.add_argument("--layers", default=",".join(LAYERS))
    parser.add_argument("--gate-on-fail", choices=("true", "false"), default="false")
    parser.add_argument("--recount", choices=("true", "false"), default="false")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session()
    end = previous_month() if args.end_month == "auto" else args.end_month
    document = fixed_rule_document()
    if args.rules:
        document = load_rule_document(spark.read.text(args.rules, wholetext=True).first()["value"])
    config = job.JobConfig(
        lake=Lake(args.root, args.landing),
        start_month=args.start_month,
        end_month=end,
        passenger_month=args.passenger_month or end,
        contracts=read_contracts(spark, args.contracts) if args.contracts else base_contracts(),
        rule_document=document,
    )
    texts = None
    if args.dictionary_texts:
        texts = spark.read.schema("dataset string, text string").json(args.dictionary_texts)
    if args.step == "check-landing":
        job.check_landing(spark, config)
        return
    if args.step == "contracts":
        if texts is None:
            raise SystemExit("contracts needs --dictionary-texts")
        job.build_contracts(spark, config.lake, texts)
        return
    if args.step == "run" and texts is not None:
        job.run_job(spark, config, texts)
        return
    job.register_tables(spark, config)
    if args.step == "run":
        job.run_job(spark, config)
    elif args.step == "ingest":
        job.refresh_bronze(spark, config)
        job.refresh_metadata(spark, config)
    elif args.step == "full-refresh":
        chosen = tuple(args.services.split(",")) if args.services else config.services
        job.rebuild_bronze(spark, config, chosen)
        job.refresh_metadata(spark, config)
    elif args.step == "silver":
        job.refresh_silver(spark, config)
    elif args.step == "gold":
        job.refresh_gold(spark, config)
    elif args.step == "quality-setup":
        quality_store.synchronise(spark, config.lake, config.rule_document)
    else:
        job.evaluate_quality(spark, config, args.layers, args.gate_on_fail == "true", recount=args.recount == "true")


if __name__ == "__main__":
    main()
