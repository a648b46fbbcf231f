"""Command line: run the pipeline over tables, write a default configuration, show or check a folder."""

from __future__ import annotations

import argparse
import json
import os
import platform
import sys

# Exit codes.
OK, FAILED, USAGE, INTERRUPTED, TERMINATED = 0, 1, 2, 130, 143


def preflight() -> dict[str, str]:
    """Versions of what a run needs; 'missing' where there is none."""
    out = {"python": platform.python_version()}
    for name in ("pyspark", "pyarrow", "pandas", "numpy"):
        try:
            out[name] = __import__(name).__version__
        except ImportError:
            out[name] = "missing"
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="annulet")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="tables to unified circles")
    r.add_argument("tables", help="folder with tandem.parquet and alignments.parquet")
    r.add_argument("output")
    r.add_argument("--config")
    r.add_argument("--preset", choices=("relaxed", "balanced", "strict"))
    r.add_argument("--prefix")
    r.add_argument("--debug", action="store_true")
    r.add_argument("--force", action="store_true", help="with --debug: make everything again")
    r.add_argument("--stop-at", help="with --debug: last stage to run")
    r.add_argument("--reference", help="FASTA of the genome; with it the package has sequences")
    r.add_argument("--id-width", type=int, default=4, help="digits of the numbers in the package")
    r.add_argument("--on-change", choices=("reset", "continue", "fail"), default="reset")
    f = sub.add_parser("package", help="the package alone, from a table of unified circles")
    f.add_argument("unified", help="folder with the table, as a run writes it")
    f.add_argument("output")
    f.add_argument("--prefix", default="sample")
    f.add_argument("--reference")
    f.add_argument("--id-width", type=int, default=4)
    c = sub.add_parser("init-config", help="write the default parameters")
    c.add_argument("path")
    s = sub.add_parser("show-checkpoint", help="what a folder holds")
    s.add_argument("output")
    sub.add_parser("validate", help="versions of what is needed")
    return p


def main(argv: list[str] | None = None, spark=None) -> int:  # noqa: ANN001
    try:
        args = parser().parse_args(argv)
    except SystemExit as e:
        return USAGE if e.code else OK
    from annulet.plans import config as C

    try:
        if args.command == "validate":
            found = preflight()
            print(json.dumps(found, indent=2))
            return FAILED if "missing" in found.values() else OK
        if args.command == "init-config":
            C.save(C.Config(), args.path)
            return OK
        if args.command == "show-checkpoint":
            from annulet.session import session
            from annulet.sources import storage

            spark, manifest = spark or session(), os.path.join(args.output, "manifest.json")
            if not storage.exists(spark, manifest):
                raise FileNotFoundError(manifest)
            print(storage.read_text(spark, manifest))
            return OK
        if args.command == "package":
            from annulet.plans import deliverable
            from annulet.session import session
            from annulet.sources import text

            spark = spark or session()
            reference = text.chunked(text.fasta(spark, args.reference)) if args.reference else None
            deliverable.write(spark, spark.read.parquet(args.unified), args.output, args.prefix, None, reference, args.id_width)
            return OK
        if (args.force or args.stop_at) and not args.debug:
            print("--force and --stop-at need --debug", file=sys.stderr)
            return USAGE
        from annulet.plans import base, pipeline
        from annulet.session import session

        conf = C.load(args.config) if args.config else C.Config()
        conf = conf.with_preset(args.preset) if args.preset else conf
        if args.prefix:
            conf = C.from_dict({"prefix": args.prefix} | {k: v for k, v in C.dataclasses.asdict(conf).items() if k != "prefix"})
        spark = spark or session()
        stages = pipeline.in_order(pipeline.standard(), {"tandem", "alignments"})
        names = [s.name for s in stages]
        if args.stop_at:
            if args.stop_at not in names:
                print(f"stages: {', '.join(names)}", file=sys.stderr)
                return USAGE
            names = names[: names.index(args.stop_at) + 1]
        inputs = {n: base.once(spark, args.tables, n) for n in ("tandem", "alignments")}
        done = pipeline.run(spark, stages, inputs, args.output, conf.check(), args.on_change, args.force, set(names))
        if not args.stop_at:
            from annulet.plans import deliverable
            from annulet.sources import text

            reference = text.chunked(text.fasta(spark, args.reference)) if args.reference else None
            deliverable.write(spark, done["unified"], f"{args.output}/package", conf.prefix, done["read_classes"], reference, args.id_width)
        return OK
    except KeyboardInterrupt:
        return INTERRUPTED
    except (C.ConfigError, pipeline_error(), OSError) as e:
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return FAILED


def pipeline_error() -> type[Exception]:
    from annulet.plans.pipeline import PipelineError

    return PipelineError


if __name__ == "__main__":
    sys.exit(main())
