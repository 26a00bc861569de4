"""Readers and writers: lines of JSON, Parquet, datasets by name, split slices, metadata beside results."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import sampling

SLICE = re.compile(r"^(\w+)(?:\[(\d*):(\d*)\])?$")
#: Datasets by name: callables (session, path) -> DataFrame.
REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Every line is a row; a malformed line ends the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_lenient(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Blank lines are skipped, a malformed line has null fields."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema if isinstance(schema, str) else schema.simpleString()).alias("r")).select("r.*")


def read_results(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """Rows of results; a malformed line is kept whole in `raw`."""
    return spark.read.schema(f"{fields}, raw string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "raw").json(path)


def read_split(df: DataFrame, split: str, order: str) -> DataFrame:
    """df cut by a split's slice, such as train[0:128], in the order of a column."""
    m = SLICE.match(split)
    if not m:
        raise ValueError(f"not a split: {split}")
    start = int(m[2] or 0)
    if m[3]:
        return sampling.sliced(df, order, start, int(m[3]))
    return df.orderBy(order).offset(start) if start else df


def read_format(spark: SparkSession, name: str, path: str, **options: str) -> DataFrame:
    """A registered dataset, or any format Spark reads."""
    if name in REGISTRY:
        return REGISTRY[name](spark, path)
    if name not in ("parquet", "json", "csv", "orc", "text"):
        raise ValueError(f"unknown dataset {name}")
    return spark.read.format(name).options(**options).load(path)


def write_jsonl(df: DataFrame, path: str, job: dict | None = None, **metrics: object) -> dict:
    """Writes lines of JSON and, beside them, metadata with the number of rows, which the write itself observes. An empty frame has metadata too."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("records")).write.mode("overwrite").json(path)
    meta = {"job": job or {}, "generated_at": datetime.now(UTC).isoformat().replace("+00:00", "Z"), "records": seen.get["records"], "metrics": metrics}
    return write_text(df.sparkSession, f"{path.rstrip('/')}.metadata.json", json.dumps(meta)) and meta


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """A small file on whatever file system the path names."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def write_parquet(df: DataFrame, path: str, first: str | None = None) -> None:
    """Parquet with one column first."""
    cols = [first, *[c for c in df.columns if c != first]] if first in df.columns else df.columns
    df.select(*cols).write.mode("overwrite").parquet(path)


def message_records(pairs: DataFrame, question: str = "question", answer: str = "answer") -> DataFrame:
    """Question and answer as a conversation of two messages; pairs without answer are left out."""
    m = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    return pairs.where(F.col(answer).isNotNull()).select(F.array(m("user", question), m("assistant", answer)).alias("messages"))


def prompt_records(df: DataFrame, column: str) -> DataFrame:
    """`prompt` first, from the given column; a column of that name from before is replaced."""
    return df.select(F.col(column).alias("prompt"), *[c for c in df.columns if c not in (column, "prompt")])


def read_config(path: str) -> dict:
    """A YAML or JSON file; an empty one is an empty dict."""
    text = Path(path).read_text()
    if path.endswith(".json"):
        return json.loads(text) if text.strip() else {}
    if path.endswith((".yaml", ".yml")):
        import yaml

        return yaml.safe_load(text) or {}
    raise ValueError(f"unknown kind of configuration: {path}")
