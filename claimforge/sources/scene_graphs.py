"""Reading scene graphs: JSON lines, Parquet, pickles (converted once), and question files of one huge JSON object."""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW


def first_existing(*candidates: str) -> str:
    """The first path that exists, else the first. Local paths only."""
    return next((c for c in candidates if Path(c).exists()), candidates[0])


def read(spark: SparkSession, path: str) -> DataFrame:
    """Scene graphs from a folder of Parquet files, or of JSON lines {"video_id": ..., "entries": {key: entry}}."""
    if path.rstrip("/").endswith((".json", ".jsonl", ".json.gz", ".jsonl.gz")):
        return spark.read.schema(RAW).json(path)
    return spark.read.schema(RAW).parquet(path)


def flat_entry(entry: dict) -> dict | None:
    """An entry in the shape of the schema: vertices and split metadata without their wrappings, broken parts left out."""
    if not isinstance(entry, dict) or entry.get("type") not in ("frame", "action"):
        return None
    out = {k: v for k, v in entry.items() if k not in ("objects", "metadata")}
    metadata = entry.get("metadata")
    out["metadata"] = metadata.get("set") if isinstance(metadata, dict) else metadata
    objects = entry.get("objects")
    vertices = objects.get("vertices", []) if isinstance(objects, dict) else []
    out["vertices"] = [flat_vertex(v) for v in vertices if isinstance(v, dict)]
    return out


def flat_vertex(v: dict) -> dict:
    box = v.get("bbox")
    out = {k: v[k] for k in ("id", "class", "visible") if k in v}
    out["bbox"] = [float(x) for x in box] if isinstance(box, list | tuple) and len(box) == 4 else None
    for kind in ("attention", "contact", "spatial", "verb"):
        items = [r for r in v.get(kind, []) if isinstance(r, dict)]
        out[kind] = [{"id": r.get("id"), "class": r.get("class"), "objects": [{"class": o.get("class")} for o in r.get("objects", []) if isinstance(o, dict)]} for r in items]
    return out


class Plain(pickle.Unpickler):
    """Only plain values: a pickle that names any class or function is refused."""

    def find_class(self, module: str, name: str):
        raise pickle.UnpicklingError(f"{module}.{name} is not a plain value")


def convert_pickle(source: str, target: str, rows_per_file: int = 1000) -> int:
    """Writes a pickled dict of scene graphs as JSON lines, ``rows_per_file`` videos a file; their number. Runs once, on one machine."""
    with open(source, "rb") as f:
        graphs = Plain(f).load()
    Path(target).mkdir(parents=True, exist_ok=True)
    items = list(graphs.items())
    for part in range(0, len(items), rows_per_file):
        with open(Path(target) / f"part-{part // rows_per_file:06}.jsonl", "w") as f:
            for video, raw in items[part : part + rows_per_file]:
                entries = {str(k): e for k, v in raw.items() if (e := flat_entry(v)) is not None}
                f.write(json.dumps({"video_id": video, "entries": entries}) + "\n")
    return len(items)


def questions(spark: SparkSession, path: str, value_schema: str) -> DataFrame:
    """(question_id, question) from files that each hold one JSON object {id: question}."""
    rows = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string,{value_schema}>").alias("m"))
    return rows.select(F.explode("m").alias("question_id", "question"))


def stream_questions(path: str) -> Iterator[tuple[str, dict]]:
    """The same from one local file, pair by pair, without holding the file: decoded from a sliding window of text."""
    decode, window, closed = json.JSONDecoder(), "", False
    with open(path, encoding="utf-8") as f:

        def fill() -> bool:
            nonlocal window, closed
            more = f.read(1 << 16)
            window, closed = window + more, not more
            return bool(more)

        def value():
            nonlocal window
            while True:
                window = window.lstrip(" \t\r\n,:")
                try:
                    found, end = decode.raw_decode(window)
                    if end < len(window) or closed:
                        window = window[end:]
                        return found
                except ValueError:
                    if closed:
                        raise
                fill()

        fill()
        window = window.lstrip("﻿ \t\r\n")
        if not window.startswith("{"):
            raise ValueError("the file holds no JSON object")
        window = window[1:]
        while True:
            window = window.lstrip(" \t\r\n,")
            if not window and fill():
                continue
            if not window or window[0] == "}":
                return
            name = value()
            yield name, value()
