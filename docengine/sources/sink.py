"""A sink of document files: texts and assets are staged by tasks and appear together when the job commits.

Rows are (filename, text, assets, error) as conversions give them, one a document; each is
converted once, as it is written. A task stages its files in a folder of its own; the driver moves them
at the commit, after it has seen that no two have one name. A job that fails leaves nothing behind.
Failed documents are listed in ``_errors`` as JSON lines.
"""

from __future__ import annotations

import base64
import json
import os
import re
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

NAME = "docengine_files"
#: Suffix of a written text by the format of its conversion.
SUFFIXES = {"markdown": ".md", "html": ".html", "json": ".json", "chunks": ".json"}
ERRORS = "_errors"


def safe_name(name: str | None) -> bool:
    """Relative, not empty, and never above the folder it is written to: the rule of ``is_safe_name`` for one name."""
    parts = (name or "").replace("\\", "/").split("/")
    depth, low = 0, 0
    for p in parts:
        depth += -1 if p == ".." else 0 if p in ("", ".") else 1
        low = min(low, depth)
    return bool((name or "").strip()) and not name.startswith("/") and not re.match("[A-Za-z]:", name) and low >= 0 and depth > 0


def local_path(path: str) -> str:
    """The path of a folder that all machines have mounted; other stores are refused."""
    path = re.sub("^file:/+", "/", path)
    if re.match("[a-z][a-z0-9+.-]+:/", path):
        raise ValueError(f"{NAME} writes to folders that all machines have mounted, not to {path}")
    return path


def text_name(filename: str, suffix: str) -> str:
    return re.sub(r"\.[^./]+$", "", filename) + suffix


@dataclass
class Staged(WriterCommitMessage):
    """The folder of a task, and the names of the files in it."""

    folder: str
    names: list[str]


class DocumentFiles(DataSource):
    """``df.write.format("docengine_files").mode("append").save(folder)``; option ``suffix`` is that of texts."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError(f"{NAME} appends files; it does not clear a folder")
        missing = {"filename", "text"} - set(schema.fieldNames())
        if missing:
            raise ValueError(f"{NAME} needs the columns {', '.join(sorted(missing))}")
        return FilesWriter(dict(self.options))


class FilesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.target = local_path(options["path"])
        self.suffix = options.get("suffix", SUFFIXES["markdown"])
        self.staging = os.path.join(self.target, f"_staging-{uuid.uuid4().hex}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        folder = os.path.join(self.staging, uuid.uuid4().hex)  # one for each attempt of a task
        names: list[str] = []

        def put(name: str, content: bytes) -> None:
            if not safe_name(name):
                raise ValueError(f"a filename leads out of the output folder or is empty: {name!r}")
            to = os.path.join(folder, name)
            if os.path.exists(to):
                raise ValueError(f"two files would have one name: {name!r}")
            os.makedirs(os.path.dirname(to), exist_ok=True)
            with open(to, "wb") as f:
                f.write(content)
            names.append(name)

        failed = []
        for batch in iterator:
            for row in batch.to_pylist():
                if row.get("error") is not None:
                    failed.append(json.dumps({"filename": row["filename"], "error": row["error"]}, ensure_ascii=False))
                    continue
                put(text_name(row["filename"], self.suffix), (row["text"] or "").encode())
                for name, content in _assets(row.get("assets")):
                    # the asset's own name must be safe, not only the path that it is part of
                    put(f"{text_name(row['filename'], '')}/{name}" if safe_name(name) else name, content)
        if failed:
            put(f"{ERRORS}/{uuid.uuid4().hex}.jsonl", "\n".join([*failed, ""]).encode())
        return Staged(folder, names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        seen: set[str] = set()
        for m in filter(None, messages):
            for name in m.names:
                if name in seen or (os.path.exists(os.path.join(self.target, name)) and os.path.isdir(os.path.join(self.target, name))):
                    raise ValueError(f"two files would have one name: {name!r}")
                seen.add(name)
        for m in filter(None, messages):
            for name in m.names:
                to = os.path.join(self.target, name)
                os.makedirs(os.path.dirname(to), exist_ok=True)
                os.replace(os.path.join(m.folder, name), to)
        shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


def _assets(text: str | None) -> Iterator[tuple[str, bytes]]:
    """(name, content) of the valid assets of a JSON object of groups."""
    for items in json.loads(text or "{}").values():
        for a in items if isinstance(items, list) else ():
            if isinstance(a, dict) and a.get("filename") and a.get("content_base64"):
                yield str(a["filename"]), base64.b64decode(a["content_base64"])


def check_names(docs: DataFrame, filename: str = "filename") -> None:
    """Refuse documents of which two would be written to one file, by their names alone: nothing is converted for it."""
    stem = F.regexp_replace(F.col(filename), r"\.[^./]+$", "")
    twice = docs.select(stem.alias("n")).groupBy("n").count().where("count > 1").head(1)
    if twice:
        raise ValueError(f"two files would have one name: {twice[0][0]!r}")


def write_files(results: DataFrame, folder: str, output_format: str = "markdown") -> None:
    """Write converted documents; results are worked out once, as they are written."""
    spark = results.sparkSession
    spark.dataSource.register(DocumentFiles)
    given = [c for c in ("filename", "text", "error") if c in results.columns]
    assets = [F.to_json("assets").alias("assets")] if "assets" in results.columns else []
    results.select(*given, *assets).write.format(NAME).option("suffix", SUFFIXES[output_format]).mode("append").save(os.path.abspath(local_path(folder)))


def read_errors(spark: SparkSession, folder: str) -> DataFrame:
    """(filename, error) of the documents that were not written."""
    kind = "filename string, error string"
    if not os.path.isdir(os.path.join(folder, ERRORS)):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).json(os.path.join(folder, ERRORS))
