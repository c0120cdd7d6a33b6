"""Small driver-side files: prompt sets, configurations, reports, and the resumable generation log."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import time
import tomllib
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import split_front_matter
from ..operators.prompts import Prompt, shuffled, split

PROMPT_KEYS = ("chat_turns", "use_multiturn", "examples", "metadata")


def load_prompts(paths: Sequence[str]) -> list[Prompt]:
    """Prompt sets of several JSON files, end to end; every entry has the four keys."""
    out = []
    for path in paths:
        entries = json.loads(Path(path).read_text(encoding="utf-8"))
        if not isinstance(entries, list):
            raise ValueError(f"{path}: the root is no list")
        for i, e in enumerate(entries):
            if not isinstance(e, dict):
                raise ValueError(f"{path}: entry {i} is no object")
            if missing := [k for k in PROMPT_KEYS if k not in e]:
                raise ValueError(f"{path}: entry {i} lacks {missing}")
            out.append(Prompt(list(e["chat_turns"]), bool(e["use_multiturn"]), [tuple(x) for x in e["examples"]], dict(e["metadata"])))
    return out


def load_raw_samples(paths: Sequence[str]) -> list[list[str]]:
    """Lists of strings as chats of one turn."""
    out = []
    for path in paths:
        entries = json.loads(Path(path).read_text(encoding="utf-8"))
        if not isinstance(entries, list) or not all(isinstance(x, str) for x in entries):
            raise ValueError(f"{path}: not a list of strings")
        out += [[x] for x in entries]
    return out


def load_balanced_split(paths: Sequence[str], proportion: float, min_size: int = 1, shuffle: bool = True, seed: int = 42) -> tuple[list, list]:
    """Every file is split by itself, so both parts hold the files in equal shares."""
    first, second = [], []
    for i, path in enumerate(paths):
        chats = load_raw_samples([path])
        a, b = split(shuffled(chats, seed + i) if shuffle else chats, proportion, min_size)
        first += a
        second += b
    return first, second


def save_prompts(prompts: Sequence[Prompt], path: str) -> None:
    if not prompts:
        raise ValueError("no prompts to save")
    Path(path).write_text(json.dumps([asdict(p) for p in prompts], separators=(",", ":"), ensure_ascii=False), encoding="utf-8")


def load_toml(path: str) -> dict[str, Any]:
    with open(path, "rb") as f:
        return tomllib.load(f)


def load_config_pair(shared: str, stage: str, required: Sequence[str] = ()) -> tuple[dict[str, Any], dict[str, Any]]:
    """Shared and stage settings; [globals] of the stage file overrides the shared ones."""
    own = load_toml(stage)
    common = load_toml(shared) | own.pop("globals", {})
    if missing := [k for k in required if k not in common and k not in own]:
        raise ValueError(f"missing settings: {missing}")
    return common, own


def write_csv(df: DataFrame, path: str) -> None:
    """A ranking as CSV with a header; order as given."""
    df.write.mode("overwrite").option("header", True).csv(path)


def update_readme(folder: str, name: str, content: str, append: bool = False) -> Path:
    """Writes a Markdown report beside a dataset; README.md keeps its YAML header."""
    if not name.endswith(".md"):
        raise ValueError(f"{name} is no Markdown file")
    path = Path(folder, name)
    old = path.read_text(encoding="utf-8") if path.exists() else ""
    header, body = split_front_matter(old) if name == "README.md" else ("", old)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(header + (body.rstrip() + "\n\n" + content if append and body.strip() else content), encoding="utf-8")
    return path


def with_retries(action: Callable[[], Any], may_retry: Callable[[Exception], bool], attempts: int = 8, base: float = 15, most: float = 300, rand: Callable[[], float] = lambda: 1.0, sleep: Callable[[float], None] = time.sleep) -> Any:
    """Runs an action again after min(base 2^(k-1), most) x rand() seconds, while errors are of the right kind."""
    for k in range(1, attempts + 1):
        try:
            return action()
        except Exception as e:
            if k == attempts or not may_retry(e):
                raise
            sleep(min(base * 2 ** (k - 1), most) * rand())
    return None


def fingerprint(*parts: Any) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


LOG_SCHEMA = "fingerprint string, turn int, row_id long, text string, error string, prompt_tokens long, completion_tokens long"


@dataclass
class TurnLog:
    """Responses per (fingerprint, turn, row) as Parquet in shared storage; what is logged is not generated again."""

    spark: SparkSession
    path: str
    fingerprint: str

    def _all(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG_SCHEMA).parquet(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], LOG_SCHEMA)
            raise

    def cached(self, turn: int) -> DataFrame:
        """One record per row; records of other fingerprints are left alone."""
        mine = self._all().where((F.col("fingerprint") == self.fingerprint) & (F.col("turn") == turn))
        return mine.dropDuplicates(["row_id"]).drop("fingerprint", "turn")

    def pending(self, rows: DataFrame, turn: int, key: str = "row_id") -> DataFrame:
        return rows.join(self.cached(turn).select(F.col("row_id").alias(key)), key, "left_anti")

    def append(self, results: DataFrame, turn: int) -> None:
        """results: row_id, text, error, prompt_tokens, completion_tokens."""
        rows = results.withColumn("fingerprint", F.lit(self.fingerprint)).withColumn("turn", F.lit(turn))
        rows.select(*[f.split()[0] for f in LOG_SCHEMA.split(", ")]).write.mode("append").parquet(self.path)

    def retire(self) -> None:
        """Forgets this fingerprint's records."""
        rest = self._all().where(F.col("fingerprint") != self.fingerprint)
        keep = rest.collect() if rest.limit(10_001).count() <= 10_000 else None
        if keep is None:
            raise ValueError("other runs' logs are too large to rewrite; give each run a folder of its own")
        self.spark.createDataFrame(keep, LOG_SCHEMA).write.mode("overwrite").parquet(self.path)


@dataclass
class BatchState:
    """Job record of an offline batch, replaced as a whole on every change."""

    path: str
    jobs: dict[str, dict[str, Any]] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str) -> BatchState:
        p = Path(path)
        return cls(path, json.loads(p.read_text()) if p.exists() else {})

    def mark(self, turn: int, **record: Any) -> None:
        self.jobs[str(turn)] = self.jobs.get(str(turn), {}) | record
        folder = os.path.dirname(self.path) or "."
        os.makedirs(folder, exist_ok=True)
        with tempfile.NamedTemporaryFile("w", dir=folder, delete=False) as f:
            json.dump(self.jobs, f)
        os.replace(f.name, self.path)
