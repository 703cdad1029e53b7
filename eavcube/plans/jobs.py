"""Command line for cluster runs, for example:

    spark-submit --py-files eavcube.zip eavcube/plans/jobs.py migrate --raw RAW --work WORK \\
        --demography POPULATION.csv --operations REGISTER.csv
    spark-submit --py-files eavcube.zip eavcube/plans/jobs.py load --work RAW --register REGISTER.csv
    spark-submit --py-files eavcube.zip eavcube/plans/jobs.py requests --work RAW --variables VERIFIED.json --out REQUESTS
    spark-submit --py-files eavcube.zip eavcube/plans/jobs.py ingest --work RAW --landing RESPONSES --state STATE
    spark-submit --py-files eavcube.zip eavcube/plans/jobs.py cube --work WORK --cube CUBE
    spark-submit --py-files eavcube.zip eavcube/plans/jobs.py features --work WORK --out FEATURES
    spark-submit --py-files eavcube.zip eavcube/plans/jobs.py train --features FEATURES --out MODEL
    spark-submit --py-files eavcube.zip eavcube/plans/jobs.py score --model MODEL --features NEW --out SCORES
    spark-submit --py-files eavcube.zip eavcube/plans/jobs.py audit --work WORK --out AUDIT
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from eavcube.operators.ordered import bounded_list
from eavcube.plans import wildfire as WF
from eavcube.schemas import SCHEMAS
from eavcube.session import make_session
from eavcube.sources.delimited import read_text_columns
from eavcube.sources.responses import VERIFIED, read_json_list, write_json
from eavcube.sources.tables import TableStore
from eavcube.streaming.incremental import start_taking


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    """Conform the register and add its rows to the stored tables."""
    store = TableStore(spark, args.work)
    for name in SCHEMAS:
        store.create_if_absent(name)
    # Stored once, since every catalogue and fact is derived from it.
    register = store.replace("register", WF.conform_register(read_text_columns(spark, args.register), args.state))
    WF.load_register(store, register)
    store.row_counts().show()


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Take the responses that have landed into the stored series; each counts once, whatever happens to the state."""
    store = TableStore(spark, args.work)
    sink = WF.response_sink(store, args.kind)
    start_taking(spark, args.landing, sink, args.state).awaitTermination()
    if args.compact:
        sink.series.compact()
        sink.ledger.compact()
    store.row_counts().show()


def requests(spark: SparkSession, args: argparse.Namespace) -> None:
    """Write what is still to be asked for, oldest fires first."""
    listed = read_json_list(spark, args.variables, VERIFIED)
    write_json(WF.open_requests(TableStore(spark, args.work), bounded_list(listed, "id")), args.out)


def migrate(spark: SparkSession, args: argparse.Namespace) -> None:
    """Clean the raw tables into the working store and show the row counts of each phase."""
    inputs = WF.MigrationInputs(
        TableStore(spark, args.raw, read_only=True), read_text_columns(spark, args.demography),
        read_text_columns(spark, args.operations),
    )
    WF.migrate(inputs, TableStore(spark, args.work), resume=args.resume, tidy=args.tidy).show(100, truncate=False)


def cube(spark: SparkSession, args: argparse.Namespace) -> None:
    """Build the star schema and store it with its summary views."""
    work, target = TableStore(spark, args.work), TableStore(spark, args.cube)
    tables = WF.build_cube(work, target)
    for name, view in WF.cube_views(tables, work.read("demografia")).items():
        target.replace(name, view)


def features(spark: SparkSession, args: argparse.Namespace) -> None:
    """Store the two feature tables."""
    work, target = TableStore(spark, args.work), TableStore(spark, args.out)
    if args.buckets:
        for name in ("climatologia", "incendios"):
            work.replace_bucketed(name, work.read(name), "id_clave_inc", args.buckets)
    variables = bounded_list(work.read("diccionario"), "id_variable")
    target.replace("lag_features", WF.lag_model_table(work, variables))
    target.replace("propagation", WF.propagation_table(work, variables))


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    """Fit the risk model on the stored features and store its scores, report and importances."""
    WF.train_model(TableStore(spark, args.features), TableStore(spark, args.out))["model_report"].show()


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    """Predict the risk of the fires of a feature store with the stored model."""
    WF.score_fires(TableStore(spark, args.model), TableStore(spark, args.features), TableStore(spark, args.out)).show()


def audit(spark: SparkSession, args: argparse.Namespace) -> None:
    """Audit the working store and store the reports."""
    official = read_json_list(spark, args.official, VERIFIED) if args.official else None
    if official is not None:
        official = official.select(F.col("id").alias("id_variable"), "nombre", "unidades")
    audits = WF.audit(TableStore(spark, args.work), TableStore(spark, args.out), official=official)
    audits["audit_references"].show(100)
    audits["audit_consistency"].show()


JOBS = {
    "load": (load, ["work", "register"]),
    "ingest": (ingest, ["work", "landing", "state"]),
    "requests": (requests, ["work", "variables", "out"]),
    "migrate": (migrate, ["raw", "work", "demography", "operations"]),
    "cube": (cube, ["work", "cube"]),
    "features": (features, ["work", "out"]),
    "train": (train, ["features", "out"]),
    "score": (score, ["model", "features", "out"]),
    "audit": (audit, ["work", "out"]),
}


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="job", required=True)
    for name, (run, options) in JOBS.items():
        command = commands.add_parser(name, help=run.__doc__)
        for option in options:
            command.add_argument(f"--{option}", required=True)
        if name == "load":
            command.add_argument("--state", default=WF.HOME_STATE)
        elif name == "features":
            command.add_argument("--buckets", type=int, default=0, help="store copies in so many buckets of the fire first")
        elif name == "audit":
            command.add_argument("--official", help="JSON list of the verified variables")
        elif name == "migrate":
            command.add_argument("--resume", action="store_true")
            command.add_argument("--tidy", action="store_true")
        elif name == "ingest":
            command.add_argument("--kind", choices=["series", "images"], default="series")
            command.add_argument("--compact", action="store_true")
    args = parser.parse_args(arguments)
    JOBS[args.job][0](make_session(f"eavcube {args.job}"), args)


if __name__ == "__main__":
    main()
