"""Pairs from a teacher under budget caps and a quality gate.

A call for a unit (document, role), slot and sample is made while what all calls before it cost is below the cap.
Calls run in waves of units: a wave's prompts are column expressions, its calls are the only Python, and its replies are
written before they are read, parsed and judged in the JVM. The rule of the caps is applied to the written calls by prefix
sums, so the pairs are those of a sequential run; only money already spent in the last wave can lie beyond the cap, and a
wave of one unit spends exactly as a sequential run does.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from decimal import Decimal
from typing import Any
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions import text as T
from tamis.operators import generate as G
from tamis.operators import judge as J
from tamis.operators import verify as V
from tamis.plans.runtime import cut, positions

#: A call of a model: messages to ``(reply, prompt tokens, completion tokens)``; it may raise.
Client = Callable[[list[dict[str, str]]], "tuple[str | None, int | None, int | None]"]

#: Prices in USD for a million tokens.
PRICE_IN, PRICE_OUT = Decimal("0.14"), Decimal("0.28")


def setting(name: str, owners: list[str], default: str | None = None, env: Mapping[str, str] | None = None) -> str | None:
    """The first filled ``TAMIS_<owner>_<name>`` of the environment, in order of the owners, else the default."""
    env = os.environ if env is None else env
    return next((v for o in owners if (v := env.get(f"TAMIS_{o}_{name}", "").strip())), default)


@dataclass(frozen=True)
class ChatClient:
    """An endpoint of the usual chat interface, asked for JSON."""

    base: str
    model: str
    key: str | None = None
    temperature: float = 0.4
    max_tokens: int = 4096
    timeout: float = 120.0
    effort: str | None = None

    @classmethod
    def of(cls, owners: list[str], env: Mapping[str, str] | None = None, **kw: Any) -> ChatClient:
        """From the environment: ``["TEACHER"]``, or ``["JUDGE", "TEACHER"]`` for a judge that falls back on the teacher."""
        return cls(setting("BASE_URL", owners, "http://localhost:8000/v1", env), setting("MODEL", owners, "teacher", env), setting("API_KEY", owners, None, env), effort=setting("EFFORT", owners, None, env), **kw)

    def body(self, messages: list[dict[str, str]]) -> dict:
        asked = {"model": self.model, "messages": messages, "temperature": self.temperature, "max_tokens": self.max_tokens, "response_format": {"type": "json_object"}}
        return asked | ({"reasoning_effort": self.effort} if self.effort else {})

    def __call__(self, messages: list[dict[str, str]]) -> tuple[str | None, int | None, int | None]:
        head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        asked = Request(f"{self.base.rstrip('/')}/chat/completions", json.dumps(self.body(messages)).encode(), head)  # noqa: S310
        with urlopen(asked, timeout=self.timeout) as r:  # noqa: S310
            got = json.load(r)
        usage = got.get("usage") or {}
        return got["choices"][0]["message"].get("content"), usage.get("prompt_tokens"), usage.get("completion_tokens")


def messages(*turns: tuple[str, Column]) -> Column:
    return F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in turns])


def teacher_prompt(prompt: Column, task: Column, context: Column, n: int = 1) -> Column:
    """System and user turn that ask for ``n`` pairs from a context."""
    user = F.concat(F.lit("Here is real code from an open project. Take it as the ground to "), task, F.lit(f".\n\nWrite {n} pair(s). An instruction must stand alone, with all code that it speaks of; a response must be whole and right.\nAnswer with one JSON object and nothing else: {{\"pairs\": [{{\"instruction\": \"...\", \"response\": \"...\"}}]}}\n\n----- code -----\n"), context, F.lit("\n----- end -----"))
    return messages(("system", prompt), ("user", user))


def judge_prompt(instruction: Column, response: Column, context: Column, limit: int = 8000) -> Column:
    """System and user turn that ask for a verdict on the axes of the rubric."""
    part = lambda name, c: F.concat(F.lit(f"----- {name} -----\n"), T.truncate(F.coalesce(c, F.lit("")), limit), F.lit("\n"))
    axes = ", ".join(f'"{a}": 0.0' for a in J.AXES)
    user = F.concat(F.lit(f"Rate the response to the instruction on every axis from 0 to 1.\nAnswer with one JSON object and nothing else: {{{axes}, \"rationale\": \"...\"}}\n\n"), part("instruction", instruction), part("response", response), part("context", context))
    return messages(("system", F.lit("You judge answers of programmers strictly and evenly, and write JSON only.")), ("user", user))


def insist(call: Client, asked: list[dict[str, str]], tries: int, backoff: float, sleep: Callable[[float], None] = time.sleep) -> tuple:
    """``(reply, prompt tokens, completion tokens, tries made)``; a reply of None after the last try."""
    for k in range(tries):
        try:
            return (*call(asked), k + 1)
        except Exception:  # a model call may fail in any way
            if k + 1 < tries:
                sleep(backoff * 2**k)
    return None, None, None, tries


def ask(df: DataFrame, prompt: Column, client: Client, tries: int = 4, backoff: float = 1.0) -> DataFrame:
    """``df`` with ``raw, prompt_tokens, completion_tokens, tries`` of one call a row. Store the result before
    using it twice, as every evaluation calls again."""
    names = df.columns
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", raw string, prompt_tokens bigint, completion_tokens bigint, tries int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [insist(client, [{"role": m["role"], "content": m["content"]} for m in p], tries, backoff) for p in b["__prompt"]]
            made = pd.DataFrame(got, columns=["raw", "prompt_tokens", "completion_tokens", "tries"], index=b.index).astype({"prompt_tokens": "Int64", "completion_tokens": "Int64"})
            yield pd.concat([b[names], made], axis=1)

    return df.withColumn("__prompt", prompt).mapInPandas(run, ddl)


def cost(prompt_tokens: Column, completion_tokens: Column, price_in: Decimal = PRICE_IN, price_out: Decimal = PRICE_OUT) -> Column:
    """USD of a call, as a decimal; missing counts cost nothing."""
    million = Decimal(1_000_000)
    each = lambda n, p: F.coalesce(n, F.lit(0)).cast("decimal(18,0)") * F.lit(p / million).cast("decimal(18,12)")
    return (each(prompt_tokens, price_in) + each(completion_tokens, price_out)).cast("decimal(28,12)")


def spend(calls: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sum of ``cost`` of all calls, or by columns; 0 without any."""
    return calls.groupBy(*(by or [])).agg(F.coalesce(F.sum("cost"), F.lit(0).cast("decimal(28,12)")).alias("spend"))


@dataclass(frozen=True)
class Plan:
    """What to make and when to stop. A gate is on when there is a verifier or judge, or more than one sample."""

    roles: list[str]
    pairs_per_doc: int = 1
    samples: int = 1
    max_pairs: int | None = None
    max_spend: float | None = None
    #: None: no check; else the options of ``verify``.
    verify: dict[str, Any] | None = None
    #: None: no judge; ``offline``: scores from hashes; else a client.
    judge: Client | str | None = None
    threshold: float = 0.0
    wave: int = 256
    tries: int = 4
    backoff: float = 1.0
    limit: int = 8000
    price_in: Decimal = PRICE_IN
    price_out: Decimal = PRICE_OUT

    @property
    def gated(self) -> bool:
        return self.verify is not None or self.judge is not None or self.samples > 1


@dataclass
class Outcome:
    """The pairs, every call that counts, and what became of the candidates."""

    pairs: DataFrame
    calls: DataFrame
    stats: dict[str, int] = field(default_factory=dict)
    spend: Decimal = Decimal(0)


CALL = ["unit", "slot", "sample"]


def planned(units: DataFrame, plan: Plan) -> DataFrame:
    """The calls of numbered units: with a gate one pair a call, for every slot and sample, at least one slot; without one
    call a unit for all its pairs, and none for no pairs."""
    if plan.gated:
        slots, samples = max(1, plan.pairs_per_doc), max(1, plan.samples)
        grid = F.sequence(F.lit(0), F.lit(slots * samples - 1))
        return units.withColumn("__k", F.explode(grid)).withColumns({"slot": F.floor(F.col("__k") / samples).cast("int"), "sample": (F.col("__k") % samples).cast("int")}).drop("__k")
    return units.withColumns({"slot": F.lit(0), "sample": F.lit(0)}) if plan.pairs_per_doc > 0 else units.withColumns({"slot": F.lit(0), "sample": F.lit(0)}).limit(0)


def called(units: DataFrame, plan: Plan, teacher: Client) -> DataFrame:
    """All calls of some units, with their parsed pairs, verdicts and costs; the teacher's replies are written, then the judge's."""
    asked = planned(units, plan).withColumn("context", T.truncate_lines(F.col("content"), plan.limit))
    n = 1 if plan.gated else plan.pairs_per_doc
    made = cut(ask(asked, teacher_prompt(F.col("prompt"), F.col("task"), F.col("context"), n), teacher, plan.tries, plan.backoff))
    made = made.withColumns({"made": F.slice(G.parsed_pairs(F.col("raw")), 1, max(1, n)), "cost": cost(F.col("prompt_tokens"), F.col("completion_tokens"), plan.price_in, plan.price_out)})
    if not plan.gated:
        return made.withColumns({"passed": F.lit(True), "verify_status": F.lit(None).cast("string"), "judge_score": F.lit(None).cast("double")})
    # One candidate a call.
    made = made.withColumns({"response": F.try_element_at("made", F.lit(1))["response"], "instruction": F.try_element_at("made", F.lit(1))["instruction"]})
    made = made.withColumns({"passed": F.lit(True), "verify_status": F.lit(None).cast("string")})
    if plan.verify is not None:
        made = V.verify(made.drop("passed", "verify_status"), **plan.verify).withColumns({"passed": F.col("verified.passed"), "verify_status": F.col("verified.status")}).drop("verified")
    if plan.judge == "offline":
        return J.judge_offline(made).drop("judge_axes").withColumn("judge_score", F.when(F.col("passed"), F.col("judge_score")))
    if plan.judge is None:
        return made.withColumn("judge_score", F.lit(None).cast("double"))
    # What failed its check, or has no candidate, is never judged and costs no judge.
    made = cut(made)
    fit = F.col("passed") & F.col("instruction").isNotNull()
    names = made.columns
    todo = made.where(fit).withColumnsRenamed({c: f"__{c}" for c in ("raw", "prompt_tokens", "completion_tokens", "tries")})
    said = cut(ask(todo, judge_prompt(F.col("instruction"), F.col("response"), F.col("context")), plan.judge, plan.tries, plan.backoff))
    verdict = cost(F.col("prompt_tokens"), F.col("completion_tokens"), plan.price_in, plan.price_out)
    said = said.withColumns({"judge_score": J.parsed_reply(F.col("raw"))["score"], "cost": F.col("cost") + verdict}).drop("raw", "prompt_tokens", "completion_tokens", "tries")
    said = said.withColumnsRenamed({f"__{c}": c for c in ("raw", "prompt_tokens", "completion_tokens", "tries")})
    return said.select(*names, "judge_score").unionByName(made.where(~fit | F.col("passed").isNull()).withColumn("judge_score", F.lit(None).cast("double")))


def survivors(calls: DataFrame, plan: Plan) -> DataFrame:
    """The pairs that the calls leave, in order of unit and slot: without a gate all, with one the best of each slot."""
    keep = [c for c in calls.columns if c not in ("instruction", "response", "made", "raw", "prompt_tokens", "completion_tokens", "tries", "cost", "passed", "content", "prompt", "task")]
    if not plan.gated:
        return calls.select(*[c for c in keep if c != "slot"], F.posexplode("made").alias("slot", "x")).select("*", "x.*").drop("x")
    ok = calls.where(F.col("passed") & F.col("instruction").isNotNull())
    if plan.judge is not None:
        ok = ok.where(F.col("judge_score") >= plan.threshold)
    return G.best_of(ok.select(*keep, "instruction", "response"), ["unit", "slot"], F.col("judge_score") if plan.judge is not None else None)


def within_spend(calls: DataFrame, cap: float | None) -> DataFrame:
    """The calls before which less than ``cap`` had been spent, in order."""
    return calls if cap is None else cut(G.running_total_cap(calls, CALL, "cost", cap))


def within_pairs(calls: DataFrame, pairs: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """The first ``max_pairs`` pairs, and the calls of the units up to the one that filled the cap. The limit is the operator."""
    if plan.max_pairs is None:
        return calls, pairs
    few = cut(G.capped_rows(pairs, ["unit", "slot"], plan.max_pairs))
    if plan.max_pairs <= 0:
        return calls.limit(0), few
    n, last = few.agg(F.count("*"), F.max("unit")).first()
    return (calls.where(F.col("unit") <= last) if n >= plan.max_pairs else calls), few


def teach(docs: DataFrame, plan: Plan, teacher: Client, order: str = "ord", content: str = "content") -> Outcome:
    """Pairs of ``docs`` against the roles, under the caps and the gate of the plan.

    Null and blank documents make no units; failing calls make no pair and cost nothing; null token counts cost nothing.
    ``pairs`` has the columns of a document but its content, with role, slot, context, instruction, response and, with a gate, verify_status and
    judge_score.
    """
    roles = G.role_table(docs.sparkSession, plan.roles, prompts=True)
    units = docs.withColumnRenamed(content, "content") if content != "content" else docs
    units = positions(G.doc_roles(units, roles), [F.col(order), F.col("role_ord")], "unit")
    n, at, waves, spent, made = units.count(), 0, [], Decimal(0), 0
    while at < n:
        if plan.max_pairs is not None and made >= plan.max_pairs or plan.max_spend is not None and spent >= Decimal(str(plan.max_spend)):
            break
        wave = cut(called(units.where((F.col("unit") >= at) & (F.col("unit") < at + plan.wave)), plan, teacher))
        spent += spend(wave).first()[0]
        made += survivors(wave, plan).count() if plan.max_pairs is not None else 0
        waves.append(wave)
        at += plan.wave
    if not waves:
        waves = [called(units.limit(0), plan, teacher)]
    calls = waves[0]
    for w in waves[1:]:
        calls = calls.unionByName(w)
    calls = within_spend(calls, plan.max_spend)
    calls, pairs = within_pairs(calls, survivors(calls, plan), plan)
    kept = pairs.count()
    stats = gate_counts(calls, plan).first().asDict() | {"kept": kept}
    return Outcome(pairs, calls, stats, spend(calls).first()[0])


def gate_counts(calls: DataFrame, plan: Plan) -> DataFrame:
    """One row: generated (candidates, not empty replies), verified_dropped, judged_dropped."""
    if not plan.gated:
        return calls.agg(F.coalesce(F.sum(F.size("made")), F.lit(0)).cast("long").alias("generated"), F.lit(0).cast("long").alias("verified_dropped"), F.lit(0).cast("long").alias("judged_dropped"))
    has, passed = F.col("instruction").isNotNull(), F.col("passed")
    low = F.col("judge_score") < plan.threshold if plan.judge is not None else F.lit(False)
    return calls.agg(F.count_if(has).alias("generated"), F.count_if(has & ~passed).alias("verified_dropped"), F.count_if(has & passed & low).alias("judged_dropped"))

