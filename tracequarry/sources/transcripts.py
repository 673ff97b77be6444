"""Assistant session transcripts to trajectories: events by line, messages by block."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

CALLS = ArrayType(StringType())
MESSAGE = StructType([StructField(n, StringType()) for n in ("role", "content", "reasoning", "tool_call_id")] + [StructField("tool_calls", CALLS)])
EVENT = StructType(
    [StructField("messages", ArrayType(MESSAGE))] + [StructField(n, BooleanType()) for n in ("user", "assistant", "tool_use", "tool_result")]
)


def compact(value) -> str:
    """JSON without blanks; text as it is."""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":"), default=str)


def as_text(value) -> str:
    """Text of a content value of any nesting."""
    if value is None:
        return ""
    if isinstance(value, list):
        return "\n".join(t for t in map(as_text, value) if t)
    if isinstance(value, dict):
        key = next((k for k in ("text", "content") if k in value), None)
        return compact(value) if key is None else as_text(value[key])
    return str(value).strip()


def _message(role: str, content: str, **more) -> dict:
    return {"role": role, "content": content, "reasoning": None, "tool_call_id": None, "tool_calls": None, **more}


def event_messages(line: str) -> dict | None:
    """Messages of one event and what it shows; None for a line that is no object."""
    try:
        event = json.loads(line)
    except ValueError:
        return None
    if not isinstance(event, dict):
        return None
    out = {"messages": [], "user": False, "assistant": False, "tool_use": False, "tool_result": False}
    if event.get("type") == "system":
        said = as_text(event.get("content"))
        out["messages"] = [_message("system", said)] if said else []
        return out
    message = event.get("message")
    if not isinstance(message, dict) or message.get("role") not in ("user", "assistant"):
        return out
    role, content = message["role"], message.get("content")
    if isinstance(content, str):
        if content.strip():
            out["messages"], out[role] = [_message(role, content.strip())], True
        return out
    blocks = [b for b in content if isinstance(b, dict)] if isinstance(content, list) else []
    said = [t for b in blocks if b.get("type") == "text" and (t := as_text(b.get("text")))]
    if role == "user":
        results = [_message("tool", as_text(b.get("content")), tool_call_id=str(b.get("tool_use_id") or "")) for b in blocks if b.get("type") == "tool_result"]
        out["messages"] = ([_message("user", "\n\n".join(said))] if said else []) + results
        out["user"], out["tool_result"] = bool(out["messages"]), bool(results)
        return out
    thoughts = [t for b in blocks if b.get("type") == "thinking" and (t := as_text(b.get("thinking")))]
    calls = [
        compact({"id": str(b.get("id") or ""), "type": "function", "function": {"name": str(b.get("name") or ""), "arguments": compact(b.get("input", {}))}})
        for b in blocks
        if b.get("type") == "tool_use"
    ]
    if said or thoughts or calls:
        more = {"reasoning": "\n\n".join(thoughts) if thoughts else None, "tool_calls": calls or None}
        out["messages"], out["assistant"], out["tool_use"] = [_message("assistant", "\n\n".join(said), **more)], True, bool(calls)
    return out


@F.pandas_udf(EVENT)
def _events(lines: pd.Series) -> pd.DataFrame:
    none = {"messages": [], "user": False, "assistant": False, "tool_use": False, "tool_result": False}
    return pd.DataFrame([event_messages(x) or none for x in lines], columns=EVENT.names)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """A row for each file with a line: file, messages by line (m), what it shows, and whether it is a trajectory."""
    lines = spark.read.text(path).select(
        F.make_valid_utf8("value").alias("value"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line")
    )
    shows = ("user", "assistant", "tool_use", "tool_result")
    files = lines.withColumn("e", _events("value")).groupBy("file").agg(
        F.sort_array(F.collect_list(F.struct("line", "e.messages"))).alias("m"), *[F.bool_or(f"e.{k}").alias(k) for k in shows]
    )
    return files.withColumn("whole", F.expr(" and ".join(shows)))


def _trajectories(files: DataFrame) -> DataFrame:
    stem = F.regexp_replace(F.regexp_extract("file", r"([^/]+)$", 1), r"\.[^.]*$", "")
    messages = F.flatten(F.transform("m", lambda x: x["messages"]))
    return files.where("whole").select(stem.alias("trajectory_id"), messages.alias("messages"), F.col("file").alias("trajectory_path"))


def scan_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Trajectories of transcript files: id is the file's stem.

    A file counts only if it shows a user, an assistant, a tool call and a tool result."""
    return _trajectories(_files(spark, path))


def convert_folder(spark: SparkSession, source: str, target: str) -> dict[str, int]:
    """Write the trajectories of ``*.jsonl`` transcripts as JSON lines; how many were converted and skipped.

    The counts are observed by the write itself, so the source is read once."""
    seen = Observation()
    files = _files(spark, f"{source}/*.jsonl").observe(seen, F.count("*").alias("files"), F.count_if("whole").alias("converted"))
    rows = _trajectories(files).select(F.col("trajectory_id").alias("id"), F.transform("messages", lambda m: F.struct(
        m["role"].alias("role"), m["content"].alias("content"), m["reasoning"].alias("reasoning"), m["tool_call_id"].alias("tool_call_id"),
        F.transform(m["tool_calls"], lambda c: F.from_json(c, "struct<id:string,type:string,`function`:struct<name:string,arguments:string>>")).alias("tool_calls"),
    )).alias("messages"))
    rows.write.mode("overwrite").json(target)
    counts = seen.get
    return {"converted": counts["converted"], "skipped": counts["files"] - counts["converted"]}
