"""The routes from sources to a built set, from a plain configuration."""

from __future__ import annotations

import importlib
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.operators import build as B
from tamis.operators import clean as C
from tamis.operators import generate as G
from tamis.operators import judge as J
from tamis.operators import pairs as P
from tamis.operators import teach as X
from tamis.operators import verify as V
from tamis.plans.runtime import cut, positions
from tamis.sources import fetch, get_source


@dataclass
class Config:
    """``mode`` is generate or import; None: import for hub sources."""

    source: str
    query: str = ""
    mode: str | None = None
    source_options: dict[str, Any] = field(default_factory=dict)
    max_results: int = 10
    clean: C.CleanOptions = field(default_factory=C.CleanOptions)
    roles: list[str] = field(default_factory=lambda: ["go_reviewer"])
    #: Options of teach.Plan; ``offline`` makes pairs without a model.
    generate: dict[str, Any] = field(default_factory=lambda: {"offline": True})
    max_pairs: int | None = None
    refine: dict[str, Any] | None = None
    name: str = "dataset"
    out: str = "data/datasets"
    val_ratio: float = 0.1
    seed: int = 42
    formats: tuple[str, ...] = ("jsonl",)
    #: One file a split, or a folder of part files written in parallel.
    single: bool = True
    #: Modules that register sources and roles.
    plugins: tuple[str, ...] = ()


#: Ready-made configurations; a configuration names one under ``preset`` and changes what it likes.
PRESETS: dict[str, dict[str, Any]] = {
    "example": {"source": "github", "max_results": 3, "roles": ["go_reviewer", "go_explainer"], "max_pairs": 20},
    "curate": {"source": "huggingface", "mode": "import", "max_results": 3000, "clean": {"min_length": 40, "max_length": 20_000, "scrub": False}, "refine": {"judge": False}},
    "review": {"source": "github", "max_results": 25, "roles": ["go_reviewer", "go_generator", "go_explainer", "go_tester"], "max_pairs": 4000, "generate": {"samples": 2, "threshold": 0.6, "max_spend": 4.0, "verify": {}, "judge": "model"}},
}


def load_config(path: str) -> Config:
    """A configuration from JSON, or YAML where a reader for it is installed."""
    import json

    with open(path, encoding="utf-8") as f:
        raw = f.read()
    try:
        data = json.loads(raw)
    except ValueError:
        import yaml  # type: ignore[import-untyped]

        data = yaml.safe_load(raw) or {}
    return configured(data)


def configured(data: dict[str, Any]) -> Config:
    """A configuration from plain values, over those of its preset."""
    name = data.pop("preset", None) if "preset" in (data := dict(data)) else None
    if name is not None and name not in PRESETS:
        raise ValueError(f"unknown preset {name!r}; known: {', '.join(sorted(PRESETS))}")
    data = (PRESETS[name] if name else {}) | data
    if isinstance(data.get("clean"), dict):
        data["clean"] = C.CleanOptions(**data["clean"])
    return Config(**data)


def load_plugins(modules: tuple[str, ...] | list[str]) -> None:
    """Imports modules for what they register."""
    for m in modules:
        importlib.import_module(m)


def gated(pairs: DataFrame, cfg: dict[str, Any]) -> DataFrame:
    """Stored pairs with ``verify_status``, ``judge_score`` and ``gate``: null for kept pairs, else what dropped them. What fails its
    check isn't judged. Without a role only build and vet are asked for."""
    out = pairs.withColumn("gate", F.lit(None).cast("string"))
    if cfg.get("verify", True):
        out = V.verify(out, strict=cfg.get("strict_verify", False), available=cfg.get("available"), runner=cfg.get("runner"))
        out = out.withColumns({"verify_status": F.col("verified.status"), "gate": F.when(~F.col("verified.passed"), "verified")}).drop("verified")
    if not cfg.get("judge", True):
        return out
    threshold = cfg.get("judge_threshold", 0.6)
    if cfg.get("client"):
        todo = cut(out)
        said = X.ask(todo.where("gate is null"), X.judge_prompt(F.col("instruction"), F.col("response"), F.col("context")), cfg["client"])
        scored = cut(said.withColumn("judge_score", J.parsed_reply(F.col("raw"))["score"]).drop("raw", "prompt_tokens", "completion_tokens", "tries"))
        out = scored.unionByName(todo.where("gate is not null").withColumn("judge_score", F.lit(None).cast("double")))
    else:
        out = J.judge_offline(out).drop("judge_axes").withColumn("judge_score", F.when(F.col("gate").isNull(), F.col("judge_score")))
    return out.withColumn("gate", F.when(F.col("gate").isNull() & ~(F.col("judge_score") >= threshold), "judged").otherwise(F.col("gate")))


def refine_stats(marked: DataFrame) -> DataFrame:
    """One row: input, verified_dropped, judged_dropped, kept."""
    g = F.col("gate")
    return marked.agg(F.count("*").alias("input"), F.count_if(g == "verified").alias("verified_dropped"), F.count_if(g == "judged").alias("judged_dropped"), F.count_if(g.isNull()).alias("kept"))


def refined(pairs: DataFrame, cfg: dict[str, Any] | None) -> DataFrame:
    """Stored pairs through the gate; without a configuration unchanged."""
    return gated(pairs, cfg).where("gate is null").drop("gate") if cfg else pairs


def generated(docs: DataFrame, roles: list[str], max_pairs_per_doc: int = 1, samples: int = 1, max_pairs: int | None = None, order: str = "ord", threshold: float | None = None, verify: dict[str, Any] | None = None) -> DataFrame:
    """Pairs of documents against roles, offline: slots, samples, check, scores, best of each slot, cap. With a gate there is at least
    one slot."""
    gate = threshold is not None or verify is not None or samples > 1
    units = G.doc_roles(docs, G.role_table(docs.sparkSession, roles))
    pairs = G.offline_pairs(units, max(1, max_pairs_per_doc) if gate else max_pairs_per_doc)
    if gate:
        pairs = pairs.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(max(1, samples) - 1))))
        if verify is not None:
            pairs = V.verify(pairs, **verify).where("verified.passed").withColumn("verify_status", F.col("verified.status")).drop("verified")
        if threshold is not None:
            pairs = J.judge_filter(J.judge_offline(pairs), threshold).drop("judge_axes")
        pairs = G.best_of(pairs, [order, "role_ord", "slot"], F.col("judge_score") if threshold is not None else None)
    return pairs if max_pairs is None else G.capped_rows(pairs, [order, "role_ord", "slot"], max_pairs)


def taught(docs: DataFrame, cfg: Config, teacher: X.Client | None = None, judge: X.Client | None = None) -> tuple[DataFrame, dict]:
    """Pairs of cleaned documents as the configuration says, and what it counted."""
    options = dict(cfg.generate)
    offline = options.pop("offline", False)
    if offline:
        known = {"pairs_per_doc": "max_pairs_per_doc", "samples": "samples", "threshold": "threshold", "verify": "verify"}
        return generated(docs, cfg.roles, max_pairs=cfg.max_pairs, **{known[k]: v for k, v in options.items() if k in known}), {}
    if options.get("judge") == "model":
        options["judge"] = judge or X.ChatClient.of(["JUDGE", "TEACHER"], temperature=0.0)
    got = X.teach(docs, X.Plan(cfg.roles, max_pairs=cfg.max_pairs, **options), teacher or X.ChatClient.of(["TEACHER"]))
    return got.pairs, got.stats | {"spend_micro_usd": int(got.spend * 1_000_000)}


def downloaded(spark: SparkSession, found: DataFrame, out: str) -> DataFrame:
    """Results of cloning records into ``out``, with their licence and ``ord``, the order in which they were found."""
    asked = cut(found.withColumn("ord", F.monotonically_increasing_id()))
    results = fetch.clone(asked, out)
    last = asked.groupBy("id").agg(F.max_by("license", "ord").alias("license"), F.min("ord").alias("ord"))
    return cut(results.join(last, "id", "left"))


def documents(spark: SparkSession, out: str, results: DataFrame) -> DataFrame:
    """Documents of the repositories that could be read, with ``ord``: repositories as found, files by path."""
    repos = results.where("status in ('success', 'cached')").select("id", "local_path", "license", "ord")
    return positions(fetch.walk_all(spark, out, repos), [F.col("repo_ord"), F.col("file_path"), F.col("id")], "ord").drop("repo_ord")


def run(spark: SparkSession, cfg: Config, teacher: X.Client | None = None, judge: X.Client | None = None) -> dict:
    """Runs a route and returns the manifest, with the counts of cleaning, generation and gate."""
    load_plugins(cfg.plugins)
    mode = cfg.mode or ("import" if cfg.source == "huggingface" else "generate")
    found = get_source(cfg.source, spark, **cfg.source_options).search(cfg.query, cfg.max_results)
    order = "ord"
    if mode == "import":
        order = str(cfg.source_options.get("order", "ord"))
        done = cut(P.import_clean(found, order))
        stats = C.clean_stats(done).first().asDict()
        pairs = C.kept(done)
    else:
        docs = documents(spark, f"{cfg.out}/raw", downloaded(spark, found, f"{cfg.out}/raw"))
        if docs.isEmpty():
            raise ValueError("no repository could be read")
        done = cut(C.clean(docs, "ord", cfg.clean))
        stats = C.clean_stats(done).first().asDict()
        pairs, counts = taught(C.kept(done), cfg, teacher, judge)
        stats |= counts
        pairs = positions(pairs.withColumnRenamed("ord", "doc_ord"), [F.col("doc_ord"), F.col("role_ord"), F.col("slot")], "ord")
    if cfg.refine:
        marked = cut(gated(pairs, cfg.refine))
        stats |= {f"refine_{k}": v for k, v in refine_stats(marked).first().asDict().items()}
        pairs = marked.where("gate is null").drop("gate")
    return B.build(pairs, cfg.name, cfg.out, order, cfg.val_ratio, cfg.seed, cfg.formats, stats, single=cfg.single)
