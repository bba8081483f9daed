"""Stored objects (images, PDFs) as rows."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.functions.scalars import media_kind, png_size

HEADER_BYTES = 512
ALLOWED_IMAGES = ("jpeg", "png")


def scan_objects(spark: SparkSession, root: str, head_bytes: int = HEADER_BYTES, glob: str | None = None) -> DataFrame:
    """(path, size, modified, head) of all objects below ``root``.

    Reads each object in full, because that is how Spark's binary source works: good for folders that hold little
    else than referenced objects.  Use :func:`probe_objects` for a few references into a large store.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select(
        "path",
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
        F.substring("content", 1, head_bytes).alias("head"),
    )


@dataclass(frozen=True)
class Store:
    """How the objects whose path starts with ``prefix`` (scheme and all) are reached.

    ``connect`` makes the client: anything with ``get_file_info`` and ``open_input_file`` like a file system of pyarrow,
    which takes paths without their scheme.  Without it the store is one of S3's kind, at ``endpoint`` if given.
    """

    prefix: str
    endpoint: str | None = None
    access_key: str | None = field(default=None, repr=False)
    secret_key: str | None = field(default=None, repr=False)
    region: str | None = None
    timeout: float = 10.0
    connect: Callable[[], object] | None = None

    def client(self):
        if self.connect is not None:
            return self.connect()
        from pyarrow.fs import S3FileSystem

        scheme, _, host = (self.endpoint or "").rpartition("://")
        given = {"endpoint_override": host, "scheme": scheme, "access_key": self.access_key, "secret_key": self.secret_key, "region": self.region}
        return S3FileSystem(request_timeout=self.timeout, connect_timeout=self.timeout, **{k: v for k, v in given.items() if v})


class _Clients:
    """One client for each store inside a task."""

    def __init__(self, stores: tuple[Store, ...]):
        self.stores = sorted(stores, key=lambda s: -len(s.prefix))
        self.made: dict[str, object] = {}
        self.lock = threading.Lock()

    def of(self, path: str):
        """(client, key of the object); ValueError if this is no path of a store."""
        for store in self.stores:
            if path.startswith(store.prefix):
                return self._kept(store.prefix, store.client), path.partition("://")[2]
        from pyarrow.fs import FileSystem

        uri = path.replace("s3a://", "s3://", 1)
        scheme, mark, rest = uri.partition("://")
        host, _, key = rest.partition("/")
        if not mark or not host:
            return FileSystem.from_uri(uri)
        client = self._kept(f"{scheme}://{host}", lambda: FileSystem.from_uri(f"{scheme}://{host}")[0])
        return client, f"{host}/{key}" if scheme in ("s3", "gs", "gcs") else f"/{key}"

    def _kept(self, name: str, make: Callable[[], object]):
        with self.lock:
            if name not in self.made:
                self.made[name] = make()
            return self.made[name]


def _ask(clients: _Clients, path: str, head_bytes: int, attempts: int, pause: float) -> tuple:
    from pyarrow.fs import FileType

    for attempt in range(attempts):
        if attempt:
            time.sleep(pause * 2 ** (attempt - 1))
        try:
            client, key = clients.of(path)
            info = client.get_file_info(key)
            if info.type != FileType.File:
                return path, "missing", None, None, None
            with client.open_input_file(key) as source:
                return path, "found", info.size, source.read(head_bytes), None
        except (FileNotFoundError, ValueError):  # gone meanwhile, or not a path
            return path, "missing", None, None, None
        except OSError as problem:  # no answer, or no access: this says nothing about the object
            error = f"{type(problem).__name__}: {problem}"
    return path, "failed", None, None, error


def ask_objects(
    paths: DataFrame, stores: Sequence[Store] = (), head_bytes: int = HEADER_BYTES, attempts: int = 3, pause: float = 0.2, requests: int = 16,
) -> DataFrame:
    """(path, outcome, size, head, error) for each row of ``paths``, which has one distinct ``path`` per row.

    ``found``: with size and first bytes.  ``missing``: the store says that there is no such object, or this is no path.
    ``failed``: the store gave no answer, or no access, ``attempts`` times, with pauses that double; nothing is known about the
    object.  Each task has one client a store and up to ``requests`` requests under way, so the work is the number of
    references, not the size of the store.  ``stores`` says how to reach some of them; the longest prefix counts.
    """
    stores = tuple(stores)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clients = _Clients(stores)
        with ThreadPoolExecutor(requests) as pool:
            for batch in batches:
                found = list(pool.map(lambda path: _ask(clients, path, head_bytes, attempts, pause), batch["path"]))
                out = pd.DataFrame(found, columns=["path", "outcome", "size", "head", "error"])
                yield out.astype({"size": "Int64"})

    return paths.filter(F.col("path").isNotNull()).select("path").mapInPandas(
        ask, "path STRING, outcome STRING, size BIGINT, head BINARY, error STRING"
    )


def probe_objects(paths: DataFrame, stores: Sequence[Store] = (), head_bytes: int = HEADER_BYTES, **options) -> DataFrame:
    """(path, size, head) for each path that exists, as :func:`ask_objects` finds it.

    If a store fails the job fails with it, so that no row counts as one without its file because of the store.
    """
    asked = ask_objects(paths, stores, head_bytes, **options)
    answered = F.when(F.col("outcome") != "failed", F.col("outcome")).otherwise(
        F.raise_error(F.concat(F.lit("no answer about "), "path", F.lit(": "), F.coalesce("error", F.lit(""))))
    )
    return asked.filter(answered == "found").select("path", "size", "head")


@F.pandas_udf(T.StructType().add("width", T.LongType()).add("height", T.LongType()))
def _jpeg_size(content: pd.Series) -> pd.DataFrame:
    """Walk the JPEG segments to the frame header, which holds height and width."""

    def size(data: bytes | None) -> tuple[int | None, int | None]:
        at = 2
        while data is not None and at + 9 <= len(data) and data[at] == 0xFF:
            marker = data[at + 1]
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                return int.from_bytes(data[at + 7 : at + 9], "big"), int.from_bytes(data[at + 5 : at + 7], "big")
            at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
        return None, None

    return pd.DataFrame([size(data) for data in content], columns=["width", "height"]).astype("Int64")


def image_metadata(spark: SparkSession, root: str, descriptions: DataFrame | None = None) -> DataFrame:
    """One metadata row per JPEG or PNG below ``root``; other kinds are left out.

    The id is a content hash, so a second run gives the same rows.  ``descriptions`` may add (filename, short_desc,
    tags).
    """
    objects = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    kind = media_kind(F.substring("content", 1, HEADER_BYTES))
    images = objects.withColumn("kind", kind).filter(F.col("kind").isin(*ALLOWED_IMAGES))
    sized = images.withColumn(
        "px", F.when(F.col("kind") == "png", png_size("content")).otherwise(
            _jpeg_size(F.when(F.col("kind") == "jpeg", F.col("content")))
        )
    )
    rows = sized.select(
        F.sha2("content", 256).alias("id"),
        F.element_at(F.split("path", "/"), -1).alias("filename"),
        F.col("path").alias("s3_path"),
        F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss").alias("upload_time"),
        F.col("length").alias("size_bytes"),
        F.upper("kind").alias("format"),
        "px.width",
        "px.height",
    )
    if descriptions is None:
        return rows.withColumns({"short_desc": F.lit(None).cast("string"), "tags": F.array().cast("array<string>")})
    return rows.join(descriptions, "filename", "left").withColumn(
        "tags", F.coalesce("tags", F.array().cast("array<string>"))
    )
