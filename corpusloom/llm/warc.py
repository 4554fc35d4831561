"""WARC archives: write, normalise a whole-file gzip to one member per record, read by index."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.session import materialize, scratch_path

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"
END = "\r\n\r\n"
CHUNK = 1 << 20
#: Repeated digests that are sent to all tasks, and, beyond them, copies from which one is (so many,
#: or so small a share of all copies).
SENT_DIGESTS, HOT_ROWS, HOT_SHARE = 200_000, 1000, 100_000


# --- writing -------------------------------------------------------------------------------------

def warc_records(df: DataFrame, id_col: str, url_col: str, payload_col: str,
                 least_bytes: int = 100, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """``value``: one record per row as text, without its closing blank lines.

    Of equal payloads of ``least_bytes`` or more the rows with the smallest id are responses and
    the others revisit it; smaller payloads are all responses. Ids are compared as they are; null
    ids come after all others.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"),
                     payload.alias("_payload"), F.sha2(payload, 256).alias("_digest"),
                     F.octet_length(payload).alias("_bytes"))
    first = materialize(rows.where(F.col("_bytes") >= least_bytes).groupBy("_digest").agg(
        F.min("_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1"), "repeated")
    joined = _with_first(rows, first, least_bytes)
    revisit = F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))

    def name(col):
        return F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(F.col(col).cast("string"), F.lit("")),
                        F.lit(">\r\n"))

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.col("_bytes").cast("string"), F.lit(END))
    size = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("_bytes"))
    url = F.when(F.col("_url").isNotNull(), F.concat(
        F.lit("WARC-Target-URI: "), F.regexp_replace("_url", r"[\r\n]+", " "), F.lit("\r\n"))
    ).otherwise("")
    head = F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name("_id"), url, F.lit(f"WARC-Date: {date}\r\n"),
        F.lit("WARC-Payload-Digest: sha256:"), F.col("_digest"), F.lit("\r\n"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name("_first"), F.lit(
            f"WARC-Profile: {REVISIT_PROFILE}\r\n"))).otherwise(""),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
        size.cast("string"), F.lit(END))
    return joined.select(F.concat(
        head, http, F.when(revisit, "").otherwise(F.col("_payload"))).alias("value"))


def _with_first(rows: DataFrame, first: DataFrame, least_bytes: int) -> DataFrame:
    """``rows`` with ``_first``, the least id of their payload where it stands more than once.

    Whole payloads stay where they are while the digests that stand twice are few enough to be sent
    to them. Past that only those of very many copies are (at most ``HOT_SHARE``), and small payloads
    still stay; the others go out by their digest, of which each has few rows.
    """
    n, copies = first.agg(F.count("*"), F.sum("_n")).first()
    known = first.select("_digest", "_first")
    if n <= SENT_DIGESTS:
        return rows.join(F.broadcast(known), "_digest", "left")
    hot = F.col("_n") > max(HOT_ROWS, copies // HOT_SHARE)
    tagged = rows.join(F.broadcast(first.where(hot).select("_digest", "_first")), "_digest", "left")
    here = F.col("_first").isNotNull() | (F.col("_bytes") < least_bytes)
    others = tagged.where(~here).drop("_first").join(
        first.where(~hot).select("_digest", "_first"), "_digest", "left")
    return tagged.where(here).unionByName(others)


def write_warc(records: DataFrame, path: str, per_file: int = 100_000) -> str:
    """Write records as archives of one gzip stream each, of up to ``per_file`` records."""
    (records.write.option("compression", "gzip").option("lineSep", END)
     .option("maxRecordsPerFile", per_file).text(path))
    return path


# --- one member per record -----------------------------------------------------------------------

def inflate(stream) -> Iterator[bytes]:
    """What a gzip stream holds, one or many members, in pieces of bounded size."""
    engine, rest = zlib.decompressobj(31), b""
    while True:
        data = rest or stream.read(CHUNK)
        if not data:
            if not engine.eof:
                piece = engine.flush()
                if piece:
                    yield piece
            return
        piece = engine.decompress(data, CHUNK)
        if piece:
            yield piece
        rest = engine.unconsumed_tail
        if engine.eof:
            rest, engine = engine.unused_data, zlib.decompressobj(31)


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records from inflated pieces, by their Content-Length."""
    held = bytearray()
    want = None
    for piece in pieces:
        held += piece
        while True:
            if want is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                want = end + 4 + int(re.search(rb"(?im)^Content-Length: *(\d+)", held[:end])[1])
            if len(held) < want + 4:
                break
            yield bytes(held[:want + 4])
            del held[:want + 4]
            want = None
    if held.strip():
        raise ValueError("the archive ends within a record")


INDEX = "file string, offset long, length long, record_id string, record_type string"


def normalise_warc(spark: SparkSession, path: str, out: str, level: int = 3) -> DataFrame:
    """Rewrite the archives below ``path`` below ``out``, every record a gzip member of its own.

    Each archive is one task that inflates the stream once and holds one record at a time. Returns
    the offset index, which is also written to ``out/index``. A task that runs twice writes another
    file; only the one that the index names counts. Paths are opened through Arrow's file systems.
    """
    def run(batches):
        for batch in batches:
            for source in batch.column("path").to_pylist():
                yield from rewrite(source)

    def rewrite(source):
        fs, place = pyarrow.fs.FileSystem.from_uri(source)
        target = f"{out}/{uuid.uuid4().hex}.warc.gz"
        into, into_place = pyarrow.fs.FileSystem.from_uri(target)
        rows, offset = [], 0
        into.create_dir(into_place.rsplit("/", 1)[0], recursive=True)
        with fs.open_input_stream(place, compression=None) as stream, \
                into.open_output_stream(into_place, compression=None) as sink:
            for record in split_records(inflate(stream)):
                engine = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = engine.compress(record) + engine.flush()
                sink.write(member)
                head = fields(record[:record.index(b"\r\n\r\n")])
                rows.append((target, offset, len(member), head["warc-record-id"],
                             head["warc-type"]))
                offset += len(member)
                if len(rows) == 10_000:
                    yield index_batch(rows)
                    rows = []
        if rows:
            yield index_batch(rows)

    def index_batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in zip(*rows)],
            ["file", "offset", "length", "record_id", "record_type"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select(
        "path")
    n = max(1, files.count())
    index = files.repartition(n, "path").mapInArrow(run, INDEX)
    index.write.parquet(f"{out}/index")
    return spark.read.schema(INDEX).parquet(f"{out}/index")


def fields(head: bytes) -> dict[str, str]:
    """Named fields of a header, names in lower case."""
    out = {}
    for line in head.decode("utf-8").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


# --- reading back --------------------------------------------------------------------------------

READ = ("record_id string, record_type string, url string, payload_bytes long, "
        "payload_digest string, refers_to string, payload binary")


def read_warc(index: DataFrame, payloads: bool = True, stretch: int = 8 << 20) -> DataFrame:
    """The records that an index names, each from its own member.

    ``payload`` is null for revisits, and everywhere if ``payloads`` is false. Of a revisit the
    size and digest of the full payload are those its headers give; of a response they are taken
    from the payload and must agree with the headers. Members are dealt to tasks by stretches of
    their archive.
    """
    def run(batches):
        for batch in batches:
            files, rows = {}, []
            for name, offset, length in zip(*(batch.column(c).to_pylist()
                                              for c in ("file", "offset", "length"))):
                if name not in files:
                    fs, place = pyarrow.fs.FileSystem.from_uri(name)
                    files[name] = fs.open_input_file(place)
                rows.append(parse(zlib.decompress(files[name].read_at(length, offset), 31)))
            for f in files.values():
                f.close()
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def parse(record):
        end = record.index(b"\r\n\r\n")
        head = fields(record[:end])
        block = record[end + 4:-4]
        http_end = block.index(b"\r\n\r\n")
        http = fields(block[:http_end])
        size, digest = int(http["content-length"]), head["warc-payload-digest"]
        kind, payload = head["warc-type"], None
        if kind == "response":
            payload = block[http_end + 4:]
            if len(payload) != size or digest != "sha256:" + hashlib.sha256(payload).hexdigest():
                raise ValueError(f"record {head['warc-record-id']} is damaged")
        return (head["warc-record-id"], kind, head.get("warc-target-uri"), size,
                digest.partition(":")[2], head.get("warc-refers-to"),
                payload if payloads else None)

    names = ["record_id", "record_type", "url", "payload_bytes", "payload_digest", "refers_to",
             "payload"]
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(),
             pa.binary()]
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (index.withColumn("_stretch", F.floor(F.col("offset") / stretch))
            .repartition(n, "file", "_stretch").sortWithinPartitions("file", "offset")
            .select("file", "offset", "length").mapInArrow(run, READ))


def archive_round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url",
                       payload_col: str = "html", least_bytes: int = 100) -> DataFrame:
    """Write a record per row, normalise the archives, read them back: id, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to``.

    Null payloads are empty payloads. A null url writes no target field. Rows with a null id are
    read back with a null id; they are responses unless an equal payload has an id. Repeated rows
    of the smallest id are all responses. Other columns are not read. An empty table writes empty
    archives and gives no rows. Archives and index lie in the shared scratch folder.
    """
    spark = df.sparkSession
    whole = write_warc(warc_records(df, id_col, url_col, payload_col, least_bytes),
                       scratch_path(spark, "warc"))
    read = read_warc(normalise_warc(spark, whole, scratch_path(spark, "warc-members")), False)
    kind = df.schema[id_col].dataType

    def bare(col):
        return F.nullif(F.regexp_extract(F.col(col), f"^<{RECORD_ID}(.*)>$", 1), F.lit("")).cast(kind)

    return read.select(bare("record_id").alias(id_col), "payload_bytes", "payload_digest",
                       "record_type", bare("refers_to").alias("refers_to"))
