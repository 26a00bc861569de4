"""Jobs: a validated configuration, its states, and the run from source to written records."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from . import rollout, sampling

#: From which state a job may go to which.
MOVES = {"pending": {"running", "cancelled", "failed"}, "running": {"completed", "failed", "cancelled"}, "completed": set(), "failed": set(), "cancelled": set()}


def merged(base: dict, over: dict) -> dict:
    """Nested dicts, the second one's leaves win."""
    return base | {k: merged(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in over.items()}


@dataclass
class JobConfig:
    """Unknown keys are ignored. One system prompt stands for a list of one, an empty list for none."""

    source: str
    path: str
    prompt_field: str = "prompt"
    key: str = "id"
    split: str | None = None
    max_examples: int | None = None
    shuffle: bool = False
    system_prompt: str | list[str] | None = None
    mode: str = "text"
    user_prompt: str | None = None
    turns: int | None = None
    tokenizer: str | None = None
    count_tokens: bool = False
    output: str | None = None
    extra: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.system_prompt = [self.system_prompt] if isinstance(self.system_prompt, str) else self.system_prompt or None
        if self.max_examples is not None and self.max_examples < 1:
            raise ValueError("max_examples is at least 1")
        if self.mode not in ("text", "tools", "multi_turn"):
            raise ValueError(f"unknown mode {self.mode}")
        if self.mode == "multi_turn" and not self.user_prompt:
            raise ValueError("multi_turn needs a user prompt")
        if self.count_tokens and not self.tokenizer:
            raise ValueError("counting tokens needs a tokenizer")

    @classmethod
    def of(cls, *parts: dict) -> JobConfig:
        """From dicts, later ones over earlier ones."""
        known: dict[str, Any] = {}
        for p in parts:
            known = merged(known, p)
        return cls(**{k: v for k, v in known.items() if k in {f.name for f in fields(cls)}})


@dataclass
class Job:
    """State and events of a job; a cancelled job stays cancelled."""

    config: JobConfig
    state: str = "pending"
    events: list[dict] = field(default_factory=list)
    result: dict | None = None

    def move(self, to: str) -> bool:
        if to not in MOVES[self.state]:
            return False
        self.state = to
        self.events.append({"offset": len(self.events), "level": "error" if to == "failed" else "info", "message": to})
        return True


def prompts_of(spark: SparkSession, config: JobConfig, pre: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Source, slice, pre-processing, then limit or sample: only rows that survive count. Null prompts are left out."""
    df = files.read_format(spark, config.source, config.path)
    if config.split:
        df = files.read_split(df, config.split, config.key)
    df = pre(df) if pre else df
    df = files.prompt_records(df, config.prompt_field).where("prompt is not null")
    if config.system_prompt:
        pick = F.pmod(F.conv(F.substring(F.md5(F.col(config.key).cast("string")), 1, 7), 16, 10).cast("bigint"), F.lit(len(config.system_prompt)))
        df = df.withColumn("system_prompt", F.element_at(F.array(*map(F.lit, config.system_prompt)), (pick + 1).cast("int")))
    if config.max_examples:
        df = sampling.sample(df, config.key, config.max_examples) if config.shuffle else sampling.first_n(df, config.key, config.max_examples)
    return df


def run_job(spark: SparkSession, config: JobConfig, backend: rollout.Backend, tools: rollout.ToolRegistry | None = None, user: rollout.Backend | None = None, pre: Callable[[DataFrame], DataFrame] | None = None, post: Callable[[DataFrame], DataFrame] | None = None) -> Job:
    """The whole run. Records are written once with their number observed on the way; an empty source writes an empty result with metadata."""
    job = Job(config)
    job.move("running")
    try:
        prompts = prompts_of(spark, config, pre)
        if config.mode == "tools":
            runner = lambda rows: rollout.tool_rollouts(backend, rows, tools or rollout.ToolRegistry(), config.turns or rollout.TOOL_TURNS)
        elif config.mode == "multi_turn":
            runner = lambda rows: rollout.user_rollouts(backend, user or backend, rows, config.turns or rollout.USER_TURNS)
        else:
            runner = lambda rows: rollout.text_rollouts(backend, rows)
        done = rollout.generate(prompts, config.key, runner, system="system_prompt" if config.system_prompt else None)
        done = post(done) if post else done
        if config.output:
            job.result = files.write_jsonl(done, config.output, {"mode": config.mode, "source": config.source})
    except Exception as e:  # noqa: BLE001
        job.events.append({"offset": len(job.events), "level": "error", "message": str(e)[:500]})
        job.move("failed")
        return job
    job.move("completed")
    return job
