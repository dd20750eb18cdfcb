"""WARC archives: a PySpark data source that writes and reads them.

``df.write.format("warc")`` writes one archive per task; ``spark.read.format("warc")`` plans one
partition per archive, parses headers first and decodes a payload only if the query reads it
and the header predicates that Spark pushed down hold. In an uncompressed archive the payload of
an unwanted record is skipped by a seek; in a compressed one its member is inflated piecewise and
dropped.

Files are opened through ``pyarrow.fs``, so the folder may lie in any store it knows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In,
                                    InputPartition, WriterCommitMessage)

from cardlens.llm.common import column_or, materialise, ready, table
from cardlens.session import scratch_path

SCHEMA = ("record_id string, record_type string, target_uri string, payload_digest string, "
          "payload_bytes long, refers_to string, payload binary")
#: Payloads shorter than this are never revisits.
MIN_REVISIT_BYTES = 100
CHUNK = 1 << 20

# Column -> header line. X-Payload-Length holds the full payload's length also where a revisit has none.
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
           "payload_digest": "WARC-Payload-Digest", "payload_bytes": "X-Payload-Length", "refers_to": "WARC-Refers-To"}
_BEGIN = b"WARC/1.1\r\n"
_VERSION = re.compile(rb"WARC/1\.\d+\r\n")
_DATE = "1970-01-01T00:00:00Z"  # capture times are not part of the data; a fixed one keeps reruns alike


def filesystem(path: str):
    """(pyarrow file system, path in it)."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _line(value: str) -> str:
    """Header values hold no line ends; in a URI these are written %0D and %0A anyway. Nothing else changes."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(row: dict) -> bytes:
    """One record. ``payload`` None or a revisit: an empty block."""
    payload = row["payload"] or b"" if row["record_type"] != "revisit" else b""
    lines = [f"{header}: {_line(str(row[name]))}" for name, header in HEADERS.items() if row[name] is not None]
    if row["record_type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += [f"WARC-Date: {_DATE}", "Content-Type: text/html", f"Content-Length: {len(payload)}"]
    return _BEGIN + "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_header(block: bytes) -> dict:
    """Column values and ``length`` of the block of header lines."""
    found = {}
    for line in block.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        found[name.strip().lower()] = value.strip().decode("utf-8", "surrogatepass")
    row = {name: found.get(header.lower().encode()) for name, header in HEADERS.items()}
    row["payload_bytes"] = int(row["payload_bytes"]) if row["payload_bytes"] is not None else None
    row["length"] = int(found[b"content-length"])
    # other writers' archives: a block of type application/http starts with HTTP headers, which are no payload
    row["http"] = (found.get(b"content-type") or "").lower().startswith("application/http")
    if row["payload_bytes"] is None and row["record_type"] != "revisit" and not row["http"]:
        row["payload_bytes"] = row["length"]
    return row


class _Plain:
    """A forward reader over an uncompressed archive that can skip."""

    def __init__(self, file):
        self.file, self.held, self.at = file, b"", file.tell()  # at: position of held[0]

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the file."""
        seen = 0
        while (i := self.held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.held)
            more = self.file.read(65536)
            if not more:
                if self.held.strip(b"\r\n"):
                    raise ValueError("truncated record")
                return None
            self.held += more
        return self._take(i + len(mark))

    def _take(self, n: int) -> bytes:
        out, self.held = self.held[:n], self.held[n:]
        self.at += n
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            more = self.file.read(max(n - len(self.held), 65536))
            if not more:
                raise ValueError("truncated record")
            self.held += more
        return self._take(n)

    def skip(self, n: int) -> None:
        if n > len(self.held):
            self.at += n
            self.held = b""
            self.file.seek(self.at)
        else:
            self._take(n)


class _Gzip(_Plain):
    """The same over an archive of gzip members, inflated piece by piece."""

    def __init__(self, file):
        super().__init__(_Inflate(file))
        self.at = 0

    def skip(self, n: int) -> None:
        while n > 0:
            if not self.held and not (more := self.file.read(65536)):
                raise ValueError("truncated record")
            elif not self.held:
                self.held = more
            n -= len(self._take(min(n, len(self.held))))


class _Inflate:
    def __init__(self, file):
        self.file, self.zip, self.rest = file, zlib.decompressobj(31), b""
        self.inside = False  # of a member

    def tell(self) -> int:
        return 0

    def read(self, n: int) -> bytes:
        while True:
            raw = self.rest or self.file.read(CHUNK)
            if not raw and not self.inside:
                return b""
            out = self.zip.decompress(raw, n)
            if not raw and not out and not self.zip.eof:
                raise ValueError("truncated archive")
            self.inside = not self.zip.eof
            self.rest = self.zip.unconsumed_tail
            if self.zip.eof:
                self.rest = self.zip.unused_data
                self.zip = zlib.decompressobj(31)
            if out:
                return out


def read_records(file, wanted, payload: bool, gzip: bool) -> Iterator[dict]:
    """All records of an archive: the header is parsed first, the payload only if wanted."""
    source = _Gzip(file) if gzip else _Plain(file)
    while True:
        block = source.until(b"\r\n\r\n")
        if block is None:
            return
        if not _VERSION.match(block):
            raise ValueError(f"not a WARC record at byte {source.at}")
        row = parse_header(block[:-4])
        size, http = row.pop("length"), row.pop("http")
        if wanted(row):
            if payload:
                block = source.take(size)
                if http:
                    block = block.partition(b"\r\n\r\n")[2]
                row["payload"] = block if row["record_type"] != "revisit" else None
            else:
                source.skip(size)
        else:
            source.skip(size)
            row = None
        # read, not skipped: a skip past the end shows here
        if source.take(4) != b"\r\n\r\n":
            raise ValueError(f"no end of a WARC record before byte {source.at}")
        if row is not None:
            yield row


@dataclass
class _Part(InputPartition):
    path: str

    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.path, self.names = options["path"], [f.name for f in schema.fields]
        self.tests: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]):
        """Equality and IN on header columns are tested on the header alone; the rest goes back to Spark."""
        for f in filters:
            name = f.attribute[0] if isinstance(f, EqualTo | In) and len(f.attribute) == 1 else None
            if name in HEADERS:
                self.tests.append((name, frozenset([f.value] if isinstance(f, EqualTo) else f.value)))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs
        store, root = filesystem(self.path)
        parts = []
        for info in sorted(store.get_file_info(fs.FileSelector(root, recursive=True)), key=lambda i: i.path):
            if info.type != fs.FileType.File or not info.base_name.endswith((".warc", ".warc.gz")):
                continue
            # whole archives: a payload may hold a record of its own, so no byte within is a safe start
            parts.append(_Part(info.path))
        return parts or [_Part("")]

    def read(self, partition):
        if not partition.path:
            return
        tests, names = self.tests, self.names
        arrow = _arrow_schema(names)
        payload = "payload" in names
        held, size = [], 0
        store, _ = filesystem(self.path)
        with store.open_input_file(partition.path) as file:
            gzip = partition.path.endswith(".gz")
            for row in read_records(file, lambda r: all(r[k] in v for k, v in tests), payload, gzip):
                held.append(row)
                size += len(row.get("payload") or b"") + 500
                if size > 8 << 20:
                    yield _batch(held, arrow)
                    held, size = [], 0
        if held:
            yield _batch(held, arrow)


def _arrow_schema(names) -> pa.Schema:
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    return pa.schema([(n, kinds.get(n, pa.string())) for n in names])


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)


@dataclass
class _Written(WriterCommitMessage):
    name: str | None
    final: str | None


class WarcWriter(DataSourceArrowWriter):
    """Each attempt writes a file of its own name; the commit gives those of successful tasks their final names.

    Final names hold the job's id, so another append to the folder never meets them. An overwrite
    removes the archives of earlier jobs once its own are complete.
    """

    def __init__(self, options, overwrite: bool = False):
        import uuid
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex
        self.gzip = options.get("compression", "gzip") != "none"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        import uuid

        from pyspark import TaskContext
        store, root = filesystem(self.path)
        store.create_dir(root, recursive=True)
        final = f"part-{TaskContext.get().partitionId():06d}-{self.job}.warc" + ".gz" * self.gzip
        name = f"_attempt-{self.job}-{uuid.uuid4().hex}"
        empty = True
        with store.open_output_stream(f"{root}/{name}") as out:
            for batch in iterator:
                for i in range(batch.num_rows):
                    empty = False
                    raw = record_bytes({k: batch.column(k)[i].as_py() for k in (*HEADERS, "payload")})
                    if self.gzip:
                        z = zlib.compressobj(4, zlib.DEFLATED, 31)
                        out.write(z.compress(raw))
                        raw = z.flush()
                    out.write(raw)
        if empty:
            store.delete_file(f"{root}/{name}")
            return _Written(None, None)
        return _Written(name, final)

    def commit(self, messages) -> None:
        from pyarrow import fs
        store, root = filesystem(self.path)
        store.create_dir(root, recursive=True)
        for m in messages:
            if m is not None and m.name:
                store.move(f"{root}/{m.name}", f"{root}/{m.final}")
        if self.overwrite:
            for info in store.get_file_info(fs.FileSelector(root, recursive=True)):
                if info.type == fs.FileType.File and info.base_name.endswith((".warc", ".warc.gz")) \
                        and self.job not in info.base_name:
                    store.delete_file(info.path)
        self._clear(store, root)

    def abort(self, messages) -> None:
        """Files of failed attempts have no archive's name, so readers pass over any that stay."""
        store, root = filesystem(self.path)
        self._clear(store, root)

    def _clear(self, store, root: str) -> None:
        """Remove what attempts of this job left that did not succeed."""
        from pyarrow import fs
        for info in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if info.base_name.startswith(f"_attempt-{self.job}"):
                store.delete_file(info.path)


class WarcSource(DataSource):
    """``format("warc")``: options ``path``, ``compression`` (gzip by record, or none), ``columns`` (comma list)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        wanted = [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]
        fields = dict(f.strip().split(" ") for f in SCHEMA.split(","))
        return ", ".join(f"{c} {fields[c]}" for c in wanted or fields)

    def reader(self, schema):
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, with predicate pushdown for Python sources."""
    ready(spark)
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def records(pages: DataFrame) -> DataFrame:
    """The records to write for ``pages`` (page_id, url, html): one per row, in the columns of SCHEMA.

    The payload is the html in UTF-8 (NULL: empty). Of payloads of MIN_REVISIT_BYTES or more that
    are equal, the row with the smallest page_id is the response and the others revisit it; if rows
    repeat that page_id, all of them are responses. NULL page_ids sort last.
    """
    spark = pages.sparkSession
    html = F.coalesce(column_or(pages, "html", "string"), F.lit("")).cast("binary")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), column_or(pages, "url", "string").alias("url"),
                        html.alias("payload"))
    facts = materialise(base.select("page_id", F.sha2("payload", 256).alias("d"), F.length("payload").alias("n"))
                        .where(F.col("n") >= MIN_REVISIT_BYTES).select("page_id", "d"), "warc-digests")
    # only digests and ids are dealt by digest: a group of copies is combined before the shuffle
    groups = materialise(facts.groupBy("d").agg(F.min("page_id").alias("first"), F.count("*").alias("c"))
                         .where("c > 1").select("d", "first"), "warc-groups")
    revisits = materialise(
        facts.join(groups, "d").where(F.col("page_id").isNotNull() & (F.col("page_id") != F.col("first")))
        .select("page_id", "d", "first").distinct(), "warc-revisits")
    # by digest as well: rows that repeat a page_id may hold copies of several payloads
    joined = base.withColumn("digest", F.sha2("payload", 256)).join(
        revisits.withColumnRenamed("d", "digest"), ["page_id", "digest"], "left")
    again = F.col("first").isNotNull()
    return joined.select(
        F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">"))
        .alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"), F.col("url").alias("target_uri"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.length("payload").cast("long").alias("payload_bytes"),
        F.when(again, F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))).alias("refers_to"),
        F.when(~again, F.col("payload")).alias("payload"))


def write_archives(pages: DataFrame, path: str, compression: str = "gzip", mode: str = "append") -> None:
    """Write ``records(pages)``; ``mode`` append adds archives to the folder, overwrite replaces those in it."""
    register(pages.sparkSession)
    records(pages).write.format("warc").mode(mode).option("compression", compression).save(path)


def read_archives(spark: SparkSession, path: str, columns: str = "") -> DataFrame:
    """The records under ``path``; ``columns`` names those to parse (default: all of SCHEMA)."""
    register(spark)
    return spark.read.format("warc").option("columns", columns).load(path)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes every row of ``pages`` to archives and reads them back.

    Responses are read with their payloads, whose length and digest are taken anew; revisits have
    no payload, so they are read from the headers alone.
    """
    import uuid

    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    full = (read_archives(spark, path).where("record_type = 'response'")
            .select(page("record_id").alias("page_id"), F.length("payload").cast("long").alias("payload_bytes"),
                    F.sha2("payload", 256).alias("payload_digest"), "record_type",
                    page("refers_to").alias("refers_to")))
    bare = (read_archives(spark, path, "record_id,record_type,payload_digest,payload_bytes,refers_to")
            .where("record_type = 'revisit'")
            .select(page("record_id").alias("page_id"), "payload_bytes",
                    F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type",
                    page("refers_to").alias("refers_to")))
    return full.unionByName(bare)


OP10_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS head FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN f.head IS NOT NULL AND p.page_id <> f.head THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.head IS NOT NULL AND p.page_id <> f.head THEN f.head END AS refers_to
FROM p LEFT JOIN f ON f.payload_digest = p.payload_digest AND p.payload_bytes >= 100
"""
