"""Zip and tar archives as tables of members, and shards written with a commit.

Archives are read by Spark's own file reader, so any store that it reaches will do; one task unpacks an archive.
"""

from __future__ import annotations

import hashlib
import io
import json
import tarfile
import unicodedata
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

MEMBERS = "path string, member string, stem string, suffix string, content binary"


def _name(member: str) -> tuple[str, str]:
    base = member.rsplit("/", 1)[-1]
    stem, dot, suffix = base.rpartition(".")
    return (stem, f".{suffix.lower()}") if dot and stem else (base, "")


def _rows(path: str, members: Iterator[tuple[str, bytes]], suffixes: tuple[str, ...] | None) -> Iterator[tuple]:
    for member, content in members:
        stem, suffix = _name(member)
        if suffixes is None or suffix in suffixes:
            yield path, member, stem, suffix, content


def _zip_members(content: bytes) -> Iterator[tuple[str, bytes]]:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for info in archive.infolist():
            if not info.is_dir():
                yield info.filename, archive.read(info)


def _tar_members(content: bytes) -> Iterator[tuple[str, bytes]]:
    with tarfile.open(fileobj=io.BytesIO(content)) as archive:
        for info in archive:
            if info.isfile():
                yield info.name, archive.extractfile(info).read()


def _unpacked(files: DataFrame, members, suffixes: tuple[str, ...] | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "member", "stem", "suffix", "content"]
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                held, size = [], 0
                for out in _rows(row["path"], members(row["content"]), suffixes):
                    held.append(out)
                    size += len(out[4])
                    if size > 1 << 24:
                        yield _batch(held, names)
                        held, size = [], 0
                if held:
                    yield _batch(held, names)

    return files.select("path", "content").mapInArrow(run, MEMBERS)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def zip_members(spark: SparkSession, path: str, suffixes: tuple[str, ...] | None = None) -> DataFrame:
    """A row for each file in each zip archive; suffixes in lower case."""
    return unpack_zip(spark.read.format("binaryFile").load(path), suffixes)


def tar_members(spark: SparkSession, path: str, suffixes: tuple[str, ...] | None = None) -> DataFrame:
    return unpack_tar(spark.read.format("binaryFile").load(path), suffixes)


def unpack_zip(files: DataFrame, suffixes: tuple[str, ...] | None = None) -> DataFrame:
    """The members of archives given as rows (path, content)."""
    return _unpacked(files, _zip_members, suffixes)


def unpack_tar(files: DataFrame, suffixes: tuple[str, ...] | None = None) -> DataFrame:
    return _unpacked(files, _tar_members, suffixes)


def samples(members: DataFrame, image: str = ".jpg", label: str = ".json") -> DataFrame:
    """Members paired by archive and stem: image and label content, null where a side is missing."""
    side = lambda suffix: F.max(F.when(F.col("suffix") == suffix, F.col("content")))
    return members.groupBy("path", F.col("stem").alias("key")).agg(side(image).alias("image"), side(label).cast("string").alias("label"))


def archive_sets(spark: SparkSession, path: str, prefix: str, kind: str) -> DataFrame:
    """The archives named {prefix}_{number}_{kind}.zip: set_id and path. A number that occurs twice is an error.

    Names are compared in composed form, whichever the store uses.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path")

    @F.pandas_udf("string")
    def composed(s):
        from urllib.parse import unquote

        return s.map(lambda x: unicodedata.normalize("NFC", unquote(x)))

    wanted = unicodedata.normalize("NFC", rf"{prefix}_(\d+)_{kind}\.zip$")
    sets = files.select(F.nullif(F.regexp_extract(composed("path"), wanted, 1), F.lit("")).cast("int").alias("set_id"), "path").where("set_id is not null")
    twice = sets.groupBy("set_id").count().where("count > 1").orderBy("set_id").select("set_id").limit(5).collect()
    if twice:
        raise ValueError(f"archives with the same number: {[r[0] for r in twice]}")
    return sets


def resolved(sets: DataFrame, archives: DataFrame, default: str) -> DataFrame:
    """The archive path of each set, or the default pattern with its number."""
    return sets.join(archives.select("set_id", "path"), "set_id", "left").withColumn("path", F.coalesce("path", F.format_string(default, F.col("set_id"))))


def tar_bytes(entries: list[tuple[str, bytes]]) -> bytes:
    """An archive without times or owners, so that equal entries give equal bytes."""
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=tarfile.USTAR_FORMAT) as archive:
        for name, content in entries:
            info = tarfile.TarInfo(name)
            info.size = len(content)
            archive.addfile(info, io.BytesIO(content))
    return out.getvalue()


def tar_shards(df: DataFrame, file: str, key: str, image: str, label: str) -> DataFrame:
    """A row for each shard file: file, samples, bytes, sha256, content. Keys in order; at most a shard's rows meet."""

    def build(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["key"])
        entries = [e for r in rows for e in ((f"{r['key']}.jpg", r["image"] or b""), (f"{r['key']}.json", (r["label"] or "{}").encode()))]
        content = tar_bytes(entries)
        return pa.table({"file": [rows[0]["file"]], "samples": pa.array([len(rows)], pa.int64()), "bytes": pa.array([len(content)], pa.int64()), "sha256": [hashlib.sha256(content).hexdigest()], "content": pa.array([content], pa.binary())})

    own = df.select(F.col(file).alias("file"), F.col(key).alias("key"), F.col(image).alias("image"), F.col(label).alias("label"))
    return own.groupBy("file").applyInArrow(build, "file string, samples long, bytes long, sha256 string, content binary")


def zip_bytes(entries: list[tuple[str, bytes]], stored: bool) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED) as archive:
        for name, content in entries:
            archive.writestr(zipfile.ZipInfo(name), content, zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED)
    return out.getvalue()


def zip_archives(df: DataFrame, file: str, member: str, content: str, stored: bool) -> DataFrame:
    """A row for each zip file: file, content. Members in order of their names; at most an archive's rows meet."""

    def build(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["member"])
        entries = [(r["member"], r["content"] or b"") for r in rows]
        return pa.table({"file": [rows[0]["file"]], "content": pa.array([zip_bytes(entries, stored)], pa.binary())})

    own = df.select(F.col(file).alias("file"), F.col(member).alias("member"), F.col(content).cast("binary").alias("content"))
    return own.groupBy("file").applyInArrow(build, "file string, content binary")


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class BinaryFiles(DataSource):
    """Sink `binary_files`: a file for each row (file, content) under `path`; names may have folders, content is bytes or text.

    Tasks write hidden temporary names; the commit renames them, an abort removes them. A file that exists
    already is an error unless the mode is overwrite.
    """

    @classmethod
    def name(cls) -> str:
        return "binary_files"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _BinaryWriter(self.options["path"], overwrite)


class _BinaryWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def _store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path.removeprefix('file:')}")

    def write(self, rows) -> _Written:
        from pyspark import TaskContext

        store, root = self._store()
        store.create_dir(root, recursive=True)
        names, made, attempt = [], set(), TaskContext.get().taskAttemptId()
        for row in rows:
            folder, slash, base = row["file"].rpartition("/")
            if folder and folder not in made:
                store.create_dir(f"{root}/{folder}", recursive=True)
                made.add(folder)
            temporary = f"{folder}{slash}.{base}.{attempt}"
            content = row["content"]
            with store.open_output_stream(f"{root}/{temporary}") as out:
                out.write(content.encode() if isinstance(content, str) else content)
            names.append(temporary)
        return _Written(names)

    def commit(self, messages) -> None:
        from pyarrow import fs

        store, root = self._store()
        names = [n for m in messages if m for n in m.names]
        parts = [n.rpartition("/") for n in names]
        targets = [folder + slash + base[1:].rsplit(".", 1)[0] for folder, slash, base in parts]
        if not self.overwrite:
            there = [i.path for i in store.get_file_info([f"{root}/{t}" for t in targets]) if i.type != fs.FileType.NotFound] if targets else []
            if there:
                self.abort(messages)
                raise FileExistsError(f"exists already: {there[:5]}")
        for temporary, target in zip(names, targets, strict=True):
            store.move(f"{root}/{temporary}", f"{root}/{target}")

    def abort(self, messages) -> None:
        store, root = self._store()
        for n in (n for m in messages if m for n in m.names):
            try:
                store.delete_file(f"{root}/{n}")
            except FileNotFoundError:
                pass


def write_files(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Writes the (file, content) rows by the committing sink; a path without a scheme is on the session's default file system."""
    spark = df.sparkSession
    spark.dataSource.register(BinaryFiles)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()
    df.select("file", "content").write.format("binary_files").option("path", whole).mode("overwrite" if overwrite else "append").save()


def canonical_json(value: dict) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))
