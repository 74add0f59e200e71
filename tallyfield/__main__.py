"""Command line: python -m tallyfield STEP ... Each step reads files or tables and writes Parquet or packs.

Settings may stand in a .env file (--env): OUTPUT_PATH is the default root, WILSON_SCORE_Z_INDEX the z of scores.
Memory and threads are Spark's own settings (spark-submit).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geo
from .functions.score import Z
from .plans import pipeline
from .sources import ingest, readers, sinks


def _typed(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A filtered Parquet table, or a raw extract that is filtered now."""
    if path.endswith((".tsv", ".txt", ".gz")):
        return getattr(ingest, kind)(readers.read_tsv(spark, path))
    return spark.read.parquet(path)


def packs_of(api: DataFrame, packs: DataFrame) -> DataFrame:
    """API hotspots with the region of the pack that they belong to: the pack at or above their finest code."""
    from .operators.packs import codes_of

    code = F.coalesce("subnational2_code", "subnational1_code", "country_code")
    where = codes_of(packs, api.select(code.alias("code")), "strict")
    return api.withColumn("code", code).join(where, "code").drop("code")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallyfield", description=__doc__)
    top.add_argument("--env", default=".env")
    steps = top.add_subparsers(dest="step", required=True)

    def step(name: str, *places: str) -> argparse.ArgumentParser:
        p = steps.add_parser(name)
        for x in places:
            p.add_argument(x)
        return p

    for name in ("extract-observations", "extract-checklists"):
        step(name, "input_file", "output")
    p = step("targets", "observations", "checklists", "taxonomy")
    p.add_argument("--output")
    p.add_argument("--wilson-z", type=float)
    p.add_argument("--version-year", required=True)
    p.add_argument("--version-month", required=True)
    p = step("grid", "observations", "checklists", "taxonomy")
    p.add_argument("--output")
    p.add_argument("--version", required=True, help="mon-yyyy")
    p.add_argument("--resolutions", type=int, nargs="+", default=[6])
    p = step("occurrences", "targets", "output")
    p.add_argument("--zone-res", type=int, nargs="+", default=[3, 4])
    p.add_argument("--version-year", required=True)
    p.add_argument("--version-month", required=True)
    p = step("packs", "targets", "output", "packs", "hotspots", "names")
    p.add_argument("--version", help="mon-yyyy")
    p.add_argument("--beta", action="store_true", help="a build of the fixed version beta, beside the releases")
    p.add_argument("--base-url", default="")
    p.add_argument("--res", type=int)
    p.add_argument("--regions", default="", help="parted by commas or spaces; all without it")
    return top


def _session(env: dict[str, str]) -> SparkSession:
    """A session; on one machine with the threads, memory and temporary folder of the settings, where they are given."""
    build = SparkSession.builder.appName("tallyfield").config("spark.sql.session.timeZone", "UTC")
    for name, key in (("MEMORY_LIMIT", "spark.driver.memory"), ("TEMP_DIRECTORY", "spark.local.dir")):
        if env.get(name):
            build = build.config(key, env[name].replace(" ", "").replace("GB", "g").replace("MB", "m"))
    return (build.master(f"local[{env['THREADS']}]") if env.get("THREADS") else build).getOrCreate()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    env = readers.load_env(args.env)
    if "resolutions" in args:
        geo.check_resolutions(args.resolutions)
    own = spark or _session(env)
    root = getattr(args, "output", None) or env.get("OUTPUT_PATH", "outputs")
    if args.step.startswith("extract-"):
        kind = args.step.removeprefix("extract-")
        # A gzip stream is one task; spread what is kept before it is written.
        getattr(ingest, kind)(readers.read_tsv(own, args.input_file)).repartition("location_id").write.mode("overwrite").parquet(args.output)
    elif args.step in ("targets", "grid"):
        c, o, s = _typed(own, args.checklists, "checklists"), _typed(own, args.observations, "observations"), readers.read_taxonomy(own, args.taxonomy)
        if args.step == "grid":
            pipeline.build_grid(own, c, o, s, root, args.version, args.resolutions)
        else:
            z = float(env.get("WILSON_SCORE_Z_INDEX", Z)) if args.wilson_z is None else args.wilson_z
            pipeline.build_targets(own, c, o, s, root, args.version_year, args.version_month, z)
    elif args.step == "occurrences":
        pipeline.build_occurrences(own, args.targets, root, args.version_year, args.version_month, tuple(args.zone_res))
    else:
        if not (args.beta or args.version):
            raise SystemExit("packs: --version or --beta")
        only = [x.upper() for x in args.regions.replace(",", " ").split()]
        api = readers.read_api_hotspots(own, args.hotspots)
        packs = readers.read_packs(own, args.packs)
        pipeline.build_packs(own, args.targets, root, packs, packs_of(api, packs), readers.read_region_names(own, args.names), "beta" if args.beta else args.version, args.base_url, args.res, only or None)


if __name__ == "__main__":
    main()
