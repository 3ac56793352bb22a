"""Command line: discover, download, process, generate, import, clean, refine, build, run."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

#: Commands and their arguments.
COMMANDS = {
    "discover": ["source", "query", "output"],
    "download": ["records", "folder", "output"],
    "process": ["results", "folder", "output"],
    "generate": ["documents", "output"],
    "import": ["path", "output"],
    "clean": ["path", "output"],
    "refine": ["path", "output"],
    "build": ["path", "name", "output"],
    "run": ["config"],
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tamis")
    sub = p.add_subparsers(dest="command", required=True)
    for name, args in COMMANDS.items():
        s = sub.add_parser(name)
        for a in args:
            s.add_argument(a)
        s.add_argument("--max", type=int, default=20)
        s.add_argument("--path-option", default=None, help="stored replies of a source")
        s.add_argument("--language", default="go")
        s.add_argument("--roles", default="go_reviewer")
        s.add_argument("--max-pairs", type=int, default=None)
        s.add_argument("--max-spend", type=float, default=None)
        s.add_argument("--samples", type=int, default=1)
        s.add_argument("--online", action="store_true", help="ask the models that the environment names")
        s.add_argument("--no-verify", action="store_true")
        s.add_argument("--strict-verify", action="store_true")
        s.add_argument("--no-judge", action="store_true")
        s.add_argument("--threshold", type=float, default=0.6)
        s.add_argument("--val-ratio", type=float, default=0.1)
        s.add_argument("--formats", default="jsonl")
        s.add_argument("--parts", action="store_true", help="part files instead of one file a split")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("tamis").getOrCreate()
    from pyspark.sql import functions as F

    from tamis.operators import build, clean, pairs
    from tamis.operators.teach import ChatClient
    from tamis.plans import pipeline
    from tamis.sources import discover
    from tamis.sources.stages import read_stage, write_stage

    if a.command == "discover":
        write_stage(discover(spark, a.source, a.query, a.max, path=a.path_option), a.output)
    elif a.command == "download":
        write_stage(pipeline.downloaded(spark, read_stage(spark, a.records), a.folder), a.output)
    elif a.command == "process":
        write_stage(clean.kept(clean.clean(pipeline.documents(spark, a.folder, read_stage(spark, a.results)))), a.output)
    elif a.command == "generate":
        judge = None if a.no_judge else "model" if a.online else "offline"
        gate = {"samples": a.samples, **({} if a.no_verify else {"verify": {"strict": a.strict_verify}}), **({"threshold": a.threshold} if judge else {}), **({"judge": judge, "max_spend": a.max_spend} if a.online else {"offline": True})}
        cfg = pipeline.Config("github", roles=a.roles.split(","), max_pairs=a.max_pairs, generate=gate)
        made, stats = pipeline.taught(read_stage(spark, a.documents), cfg)
        write_stage(made, a.output)
        print(json.dumps(stats))
    elif a.command == "import":
        found = discover(spark, "huggingface", "", a.max, path=a.path, language=a.language)
        write_stage(clean.kept(pairs.import_clean(found)), a.output)
    elif a.command == "clean":
        write_stage(clean.kept(clean.clean(read_stage(spark, a.path))), a.output)
    elif a.command == "refine":
        cfg = {"verify": not a.no_verify, "strict_verify": a.strict_verify, "judge": not a.no_judge, "judge_threshold": a.threshold, **({"client": ChatClient.of(["JUDGE", "TEACHER"], temperature=0.0)} if a.online else {})}
        marked = pipeline.cut(pipeline.gated(read_stage(spark, a.path), cfg))
        write_stage(marked.where(F.col("gate").isNull()).drop("gate"), a.output)
        print(json.dumps(pipeline.refine_stats(marked).first().asDict()))
    elif a.command == "build":
        print(json.dumps(build.build(read_stage(spark, a.path), a.name, a.output, val_ratio=a.val_ratio, formats=tuple(a.formats.split(",")), single=not a.parts), indent=2))
    else:
        print(json.dumps(pipeline.run(spark, pipeline.load_config(a.config)), indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
