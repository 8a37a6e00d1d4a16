"""Web archives with one Zstandard frame per record and the dictionary in a leading skippable frame.

``write`` lays pages out as archives in a shared folder and returns their paths; ``read`` streams archives back frame by
frame: it loads the dictionary, decodes one record at a time and validates headers, lengths and digests. A task that is
run again writes new files under new names; only those that the committed list names are ever read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the archive and compression formats.
SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
DATE = "2024-01-01T00:00:00Z"

RECORD = "record_id string, uri string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to string, problem string"


def mark_revisits(df: DataFrame, id_col: str, payload_col: str, least: int = 1000) -> DataFrame:
    """Add ``refers_to``: of rows with equal payloads of at least ``least`` bytes the largest id, null on that row itself.

    A null id counts as smaller than any other. Copies are pre-aggregated before the shuffle; a hot payload is one row of
    the small side of the join.
    """
    large = F.length(payload_col) >= least
    keyed = df.withColumn("__k", F.when(large, F.sha2(payload_col, 256)))
    first = keyed.where("__k IS NOT NULL").groupBy("__k").agg(F.max(id_col).alias("__m"), F.count("*").alias("__n")).where("__n > 1 AND __m IS NOT NULL").drop("__n")
    later = F.col("__m").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("__m"))
    return keyed.join(first, "__k", "left").withColumn("refers_to", F.when(later, F.col("__m"))).drop("__k", "__m")


def _line(text: str) -> str:
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record(record_id: str, uri: str | None, payload: bytes, refers_to: str | None) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{_line(record_id)}>", f"WARC-Date: {DATE}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {_line(uri)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_line(refers_to)}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record; ``problem`` says what is wrong with it, else None."""
    out = dict.fromkeys(("record_id", "uri", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to", "problem"))
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or not lines[0].startswith("WARC/1."):
        return out | {"problem": "no record header"}
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    out |= {"record_id": fields.get("warc-record-id", "").strip("<>") or None, "uri": fields.get("warc-target-uri"), "record_type": fields.get("warc-type"), "refers_to": fields.get("warc-refers-to", "").strip("<>") or None}
    if missing := [x for x in REQUIRED if not fields.get(x)]:
        return out | {"problem": f"no {missing[0]}"}
    size = int(fields["content-length"]) if fields["content-length"].isdigit() else -1
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        return out | {"problem": "length differs from content-length"}
    http, mark, payload = rest[:size].partition(b"\r\n\r\n")
    inner = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("utf-8", "replace").split("\r\n")[1:])}
    stated = fields.get("warc-payload-digest", "")
    try:
        digest = base64.b32decode(stated.removeprefix("sha1:")).hex()
    except ValueError:
        digest = ""
    if not mark or not inner.get("content-length", "").isdigit() or not stated.startswith("sha1:") or len(digest) != 40:
        return out | {"problem": "no payload length or digest"}
    out |= {"payload_bytes": int(inner["content-length"]), "payload_digest": digest}
    if out["record_type"] == "revisit":
        return out | {"problem": None if out["refers_to"] and not payload else "revisit without target, or with payload"}
    out["payload"] = payload
    if len(payload) != out["payload_bytes"]:
        return out | {"problem": "payload length differs"}
    return out | {"problem": None if hashlib.sha1(payload).hexdigest() == digest else "payload digest differs"}


def dictionary(samples: list[bytes], size: int) -> bytes:
    """A dictionary trained on the samples; their own bytes where there are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except (zstandard.ZstdError, MemoryError):
        return b"".join(samples)[:size]


def pack(records: Iterator[bytes], put, sample: int, dict_bytes: int) -> int:
    """Write one archive; the dictionary comes from its first ``sample`` records."""
    import zstandard

    head = [x for _, x in zip(range(sample), records, strict=False)]
    raw = dictionary([x[:8192] for x in head], dict_bytes)
    put(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
    make = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=True)
    n = 0
    for source in (head, records):
        for x in source:
            put(make.compress(x))
            n += 1
    return n


def unpack(get, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive, one frame at a time. ``get(n)`` returns up to n further bytes."""
    import zstandard

    data, known = b"", None
    while len(data) < 8 and (more := get(chunk)):
        data += more
    if len(data) >= 8 and struct.unpack("<I", data[:4])[0] == SKIPPABLE:
        size = struct.unpack("<I", data[4:8])[0]
        while len(data) < 8 + size:
            if not (more := get(chunk)):
                raise ValueError("the dictionary frame is cut off")
            data += more
        raw, data = data[8 : 8 + size], data[8 + size :]
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw) if raw[:4] == FRAME else raw
        known = zstandard.ZstdCompressionDict(raw) if raw else None
    dec = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    while data or (data := get(chunk)):
        frame, parts = dec.decompressobj(), []
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                data = frame.unused_data
                break
            if not (data := get(chunk)):
                raise ValueError("the last frame is cut off")
        yield b"".join(parts)


def write(df: DataFrame, folder: str, archive_bytes: int = 64 << 20, sample: int = 200, dict_bytes: int = 16_384) -> DataFrame:
    """Write rows (record_id string, uri string, payload binary, refers_to string) as archives of about ``archive_bytes``.

    ``folder``: a URI that all executors share. Returns (path, records), to be stored before it is used.
    A null payload is empty; a null record id is written as ``null``.
    """

    def run(batches):
        from pyarrow import fs

        place, top = fs.FileSystem.from_uri(folder)
        place.create_dir(top, recursive=True)
        rows = (x for b in batches for i in range(0, b.num_rows, 64) for x in b.slice(i, 64).to_pylist())
        head = next(rows, None)
        while head is not None:
            name = f"{top}/{uuid.uuid4().hex}.warc.zst"
            left = archive_bytes

            def some(head=head):
                nonlocal left, rest
                while head is not None:
                    data = record(head["record_id"] or "null", head["uri"], head["payload"] or b"", head["refers_to"])
                    left -= len(data)
                    yield data
                    head = next(rows, None)
                    if left <= 0:
                        break
                rest = head

            rest = None
            with place.open_output_stream(name + ".part", compression=None) as out:
                n = pack(some(), out.write, sample, dict_bytes)
            place.move(name + ".part", name)
            yield pa.RecordBatch.from_pydict({"path": [name], "records": pa.array([n], pa.int64())})
            head = rest

    return df.select("record_id", "uri", "payload", "refers_to").mapInArrow(run, "path string, records long")


def read(paths: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives listed in column ``path`` of ``paths`` with the columns of ``RECORD``.

    A record that fails a check keeps what could be read and says why in ``problem``; a frame that cannot be decoded fails
    the task, since nothing after it can be trusted.
    """

    def run(batches):
        from pyarrow import fs

        place, _ = fs.FileSystem.from_uri(folder)
        schema = pa.schema([(n, {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}[t]) for n, t in (x.split() for x in RECORD.split(", "))])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with place.open_input_stream(path, compression=None) as f:
                    rows, size = [], 0
                    for data in unpack(f.read):
                        rows.append(parse(data))
                        size += len(data)
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    tasks = max(1, min(paths.count(), 10_000))  # a stated number: few bytes of paths stand for many of archives
    return paths.select("path").repartition(tasks, "path").mapInArrow(run, RECORD)
