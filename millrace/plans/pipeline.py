"""The pipeline end to end: raw records to clean, rejected and split records with their reports; and its small inputs."""

from __future__ import annotations

import hashlib
import json
import os
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import clean, report
from millrace.session import stage
from millrace.sources import jsonl


@dataclass(frozen=True)
class MixPlan:
    min_rows: int = 0
    max_topic: float = 1.0
    least: dict[str, dict[str, float]] = field(default_factory=dict)

    @staticmethod
    def read(path: str) -> MixPlan:
        told = json.loads(Path(path).read_text("utf-8"))
        if not isinstance(told, dict):
            raise ValueError(f"{path}: not an object")
        least = {dim: {str(k): float(v) for k, v in told.get(f"{dim}_min_ratio", {}).items()} for dim in ("content_type", "lang_mode")}
        return MixPlan(int(told.get("min_rows", 0)), float(told.get("max_single_topic_ratio", 1.0)), least)


def mix_verdict(rows: DataFrame, plan: MixPlan, order: str = "line_no") -> list[str]:
    """Failures in order: too few rows, categories below their share (as the plan lists them), one topic above its share.
    What reaches the driver is the table of counts of planned categories and one topic."""
    spark = rows.sparkSession
    mix = stage(report.content_mix(rows), "mix")
    total = mix.filter("dim = 'all'").select("n").first()
    n = total["n"] if total else 0
    failures = [f"too_few_rows:{n}<{plan.min_rows}"] if n < plan.min_rows else []
    planned = [(dim, v, x) for dim, least in plan.least.items() for v, x in least.items()]
    if planned:
        low = {(r["dim"], r["value"]): r for r in report.mix_failures(mix, spark.createDataFrame(planned, "dim string, value string, least double")).collect()}
        for dim, v, x in planned:
            if (dim, v) in low:
                failures.append(f"{'content' if dim == 'content_type' else 'lang'}_ratio_low:{v}:{low[dim, v]['ratio']:.4f}<{x:.4f}")
    topic = report.top_value(rows.withColumn("_topic", F.coalesce(F.nullif(T.norm(F.col("topic")), F.lit("")), F.lit("unknown"))), "_topic", order).first()
    if topic and n and topic["n"] / n > plan.max_topic:
        failures.append(f"topic_concentration_high:{topic['_topic']}:{topic['n'] / n:.4f}>{plan.max_topic:.4f}")
    return failures


def run(spark: SparkSession, raw: str | list[str], out: str, plan: MixPlan | None = None, train: float = 0.9, val: float = 0.05, least: int = 100) -> dict:
    """Reads JSON lines, writes `clean`, `rejects` and `splits` under `out`, gives the reports as a dictionary.

    Line numbers begin anew in each file, so rows are in the order of file and line number together."""
    lines = jsonl.read_jsonl(spark, raw)
    v = F.col("v")
    fields = {c: jsonl.field(v, f"$.{c}") for c in ("id", "conversation_id", "lang_mode", "topic", "task_type", "content_type", "source", "created_at")}
    prompt, response = jsonl.prompt_of(F.col("value"), v), jsonl.response_of(F.col("value"), v)
    rows = lines.select("file", "line_no", F.struct("file", "line_no").alias("at"), prompt.alias("prompt"), response.alias("response"), *[c.alias(k) for k, c in fields.items()], F.col("value").alias("record"))
    told = stage(clean.with_clean_reason(rows, "at"), "told")
    kept = stage(told.filter("reason = 'ok'").drop("reason", "record"), "kept")
    jsonl.write_jsonl(kept.drop("at"), f"{out}/clean", "overwrite")
    jsonl.write_jsonl(told.filter("reason <> 'ok'").select("file", "line_no", "reason", "record"), f"{out}/rejects", "overwrite")
    split = stage(report.with_split(kept.drop("at"), train, val), "split")
    jsonl.write_splits(split, f"{out}/splits")
    summaries = report.summary(split, ["split"])
    return {
        "reasons": {r["reason"]: r["n"] for r in clean.reason_counts(told).collect()},
        "mix_failures": mix_verdict(kept, plan, "at") if plan else [],
        "splits": {r["split"]: r["n_rows"] for r in summaries.collect()},
        "preflight_failures": sorted(r["failure"] for r in report.preflight(summaries, "split", least).collect()),
    }


def read_topics(path: str | None, default: list[str]) -> list[str]:
    """Topics of a file, one a line, normalised; the default list if there is no path."""
    if not path:
        return list(default)
    topics = [" ".join(x.split()) for x in Path(path).read_text("utf-8").splitlines()]
    topics = [t for t in topics if t]
    if not topics:
        raise RuntimeError(f"{path}: no topics")
    return topics


def read_env(path: str) -> None:
    """Settings of a file of NAME=value lines, where the environment hasn't them; one pair of quotes is taken off."""
    if not os.path.exists(path):
        return
    for line in Path(path).read_text("utf-8").splitlines():
        name, eq, value = line.strip().partition("=")
        if eq and name and not name.startswith("#"):
            value = value.strip()
            if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'":
                value = value[1:-1]
            os.environ.setdefault(name.strip(), value)


def files_fingerprint(**paths: str) -> str:
    """SHA-256 over names, sizes and times of files (not their content: see the catalogue's content_fingerprint)."""
    told = {}
    for name, path in paths.items():
        if path:
            at = Path(path).resolve()
            told[name] = {"path": str(at), "size": at.stat().st_size, "mtime_ns": at.stat().st_mtime_ns}
    return hashlib.sha256(json.dumps(told, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def config_fingerprint(path: str) -> str:
    """SHA-256 of a file's bytes."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def run_id(name: str, config: str, data: str) -> str:
    """A run's id from its name and the fingerprints of its configuration and data."""
    return hashlib.sha1(f"{name}:{config}:{data}".encode()).hexdigest()[:12]


def out_path(prefix: str, suffix: str) -> str:
    """An output beside others of its prefix."""
    return f"{prefix}.{suffix}"


def read_config(path: str) -> dict:
    """A run's configuration: JSON, or YAML where a reader for it is installed."""
    text = Path(path).read_text("utf-8")
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError(f"{path}: no YAML reader is installed") from e
        told = yaml.safe_load(text)
    else:
        told = json.loads(text)
    if not isinstance(told, dict):
        raise ValueError(f"{path}: not an object")
    return told


def preflight_files(spark: SparkSession, least: int = 100, **paths: str) -> dict:
    """The check before training: files that are missing and files with too few valid pairs, in the order given, their
    summaries, and the fingerprint of all if nothing failed."""
    there = {name: path for name, path in paths.items() if Path(path).exists()}
    summaries: dict[str, dict] = {}
    for name, path in there.items():  # a file each, as many as there are splits
        row = jsonl.summarize_lines(spark.read.text(path), []).first()
        summaries[name] = row.asDict()
    failures = []
    for name, path in paths.items():
        if name not in there:
            failures.append(f"missing:{name}:{path}")
        elif summaries[name]["valid_pairs"] < least:
            failures.append(f"too_few_valid_rows:{name}:{summaries[name]['valid_pairs']}")
    return {"ok": not failures, "failures": failures, "dataset_fingerprint": "" if failures else files_fingerprint(**paths), "summaries": summaries}


def append_metrics(path: str, step: int, **values: float) -> None:
    """One JSON line more in a local log of metrics."""
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps({"step": step, **values}) + "\n")


def write_report(path: str, told: dict) -> None:
    """An indented JSON document, moved into place when it is whole."""
    at = Path(path)
    at.parent.mkdir(parents=True, exist_ok=True)
    part = at.with_name(at.name + ".part")
    part.write_text(json.dumps(told, indent=2, ensure_ascii=False), "utf-8")
    part.replace(at)
