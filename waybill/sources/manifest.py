"""Provenance of input files."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from waybill.sources.readers import OPTIONAL, TRIP_COLUMNS, IncompleteSource, conform_trips
from waybill.sources.sinks import discard, scratch_folder, staged

if TYPE_CHECKING:
    import pandas as pd
    import pyarrow as pa

#: Bytes of the largest file that a task reads whole.
WHOLE_BYTES = 128 << 20
#: Bytes of a larger file that a task hashes before it hands the hash's state on.
TURN_BYTES = 256 << 20
#: Bytes of the rows that larger files are kept in meanwhile.
PART_BYTES = 32 << 10

_SCHEMA = (
    "file_name string, file_path string, file_size_bytes bigint, num_rows bigint,"
    " num_columns int, num_row_groups int, schema_columns array<string>,"
    " schema_types array<string>, sha256 string, status string"
)
_COLUMNS = [field.split()[0] for field in _SCHEMA.split(", ")]


def _describer(columns: list[str]):
    """The per-task function, closed over what it needs so that executors run it
    without this package installed. It sees the ends of files, never whole ones."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for path, size, digest, footer in batch.itertuples(index=False, name=None):
                if not (footer or b"").endswith(b"PAR1"):
                    raise ValueError(f"{path} is not a Parquet file")
                found = pq.ParquetFile(pa.BufferReader(b"PAR1" + footer))
                meta, schema = found.metadata, found.schema_arrow
                rows.append(
                    (path.rsplit("/", 1)[-1], path, size, meta.num_rows, len(schema.names),
                     meta.num_row_groups, schema.names, [str(t) for t in schema.types], digest,
                     "VERIFIED_COMPLETE" if meta.num_rows else "EMPTY")
                )
            yield pd.DataFrame(rows, columns=columns)

    return describe


def _files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
    )


def _joiner(size: int):
    """The task that joins the lines of files' ranges to parts of ``size`` bytes."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        key, part, held = None, 0, bytearray()

        def parts(ended: bool) -> Iterator[pa.RecordBatch]:
            nonlocal part, held
            end = len(held) if ended else len(held) // size * size
            for low in range(0, end, 512 * size):
                high = min(end, low + 512 * size)
                found = [bytes(held[at : min(at + size, end)]) for at in range(low, high, size)]
                count = len(found)
                yield pa.record_batch(
                    [
                        pa.array([key[0]] * count, pa.int32()),
                        pa.array([key[1]] * count, pa.int64()),
                        pa.array(range(part, part + count), pa.int32()),
                        pa.array(found, pa.binary()),
                    ],
                    ["file", "start", "part", "bytes"],
                )
                part += count
            held = held[end:]

        for batch in batches:
            files, starts = (batch.column(i).to_numpy() for i in (0, 1))
            new = np.flatnonzero((np.diff(files) != 0) | (np.diff(starts) != 0)) + 1
            for low, high in zip([0, *new], [*new, len(files)]):
                if low == high:
                    continue
                if key != (files[low], starts[low]):
                    yield from parts(True)
                    key, part = (files[low], starts[low]), 0
                held += b"\n".join(batch.column(2).slice(low, high - low).to_pylist()) + b"\n"
                yield from parts(False)
        yield from parts(True)

    return join


def _hasher(last: bool, native: bool = True):
    """The task that continues SHA-256 of files. A file's rows are its state, then its next
    bytes in order; its new state, or the digest at the ``last`` turn, is the row returned.

    ``hashlib`` does not give its state away. The block function of the library beneath it does,
    and where that is not to be had, the same in Python takes its place, some thousand times
    slower.
    """

    def blocks_of():
        import ctypes
        import hashlib
        import math
        import struct

        primes = [n for n in range(2, 312) if all(n % d for d in range(2, math.isqrt(n) + 1))]
        first = [math.isqrt(p << 64) & 0xFFFFFFFF for p in primes[:8]]

        def root(n: int) -> int:
            found = round(n ** (1 / 3))
            while found**3 > n:
                found -= 1
            while (found + 1) ** 3 <= n:
                found += 1
            return found & 0xFFFFFFFF

        rounds = [root(p << 96) for p in primes]

        def turned(x: int, by: int) -> int:
            return (x >> by | x << 32 - by) & 0xFFFFFFFF

        def plain(words, data):
            for (*w,) in struct.iter_unpack(">16I", data):
                for i in range(16, 64):
                    x, y = w[i - 15], w[i - 2]
                    x = turned(x, 7) ^ turned(x, 18) ^ x >> 3
                    y = turned(y, 17) ^ turned(y, 19) ^ y >> 10
                    w.append(w[i - 16] + x + w[i - 7] + y & 0xFFFFFFFF)
                a, b, c, d, e, f, g, h = words
                for k, x in zip(rounds, w):
                    one = h + (turned(e, 6) ^ turned(e, 11) ^ turned(e, 25)) + (e & f ^ ~e & g) + k + x
                    two = (turned(a, 2) ^ turned(a, 13) ^ turned(a, 22)) + (a & b ^ a & c ^ b & c)
                    a, b, c, d, e, f, g, h = one + two & 0xFFFFFFFF, a, b, c, d + one & 0xFFFFFFFF, e, f, g
                words = [x + y & 0xFFFFFFFF for x, y in zip(words, (a, b, c, d, e, f, g, h))]
            return words

        if not native:
            return first, plain
        try:
            import _hashlib

            update = ctypes.CDLL(_hashlib.__file__).SHA256_Update
        except (ImportError, AttributeError, OSError):
            return first, plain

        def quick(words, data):
            # Eight words of state, then the library's own counts and buffer, here unused.
            state = (ctypes.c_uint32 * 28)(*words)
            update(state, data, ctypes.c_size_t(len(data)))
            return state[:8]

        sample = b"\x80" + bytes(63)
        holds = struct.pack(">8I", *quick(first, sample)) == hashlib.sha256().digest()
        return first, quick if holds else plain

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import struct

        import pyarrow as pa

        first, blocks = blocks_of()
        file, length, done, words, rest = None, 0, 0, first, b""

        def ended() -> pa.RecordBatch:
            digest, state = None, struct.pack(">8I", *words) + rest
            if last:
                # A text's last line may end without a mark; the file's length tells.
                if done not in (length, length + 1):
                    raise ValueError(f"a file of {length} bytes has {done} now")
                fill = b"\x80" + bytes(-(length + 9) % 64) + struct.pack(">Q", 8 * length)
                digest = struct.pack(">8I", *blocks(words, rest + fill)).hex()
            row = [(file, pa.int32()), (length, pa.int64()), (done, pa.int64()), (state, pa.binary()), (digest, pa.string())]
            return pa.record_batch([pa.array([v], t) for v, t in row], ["file", "length", "done", "bytes", "sha256"])

        for batch in batches:
            new = []
            for now, size, before, data in zip(*(batch.column(c).to_pylist() for c in ("file", "length", "done", "bytes"))):
                if before is None:
                    new.append(data[: max(0, length - done)])
                    done += len(data)
                    continue
                if file is not None:
                    rest += b"".join(new)
                    whole = len(rest) // 64 * 64
                    words, rest, new = blocks(words, rest[:whole]), rest[whole:], []
                    yield ended()
                file, length, done, rest = now, size, before, data[32:]
                words = list(struct.unpack(">8I", data[:32])) if data else first
            rest += b"".join(new)
            whole = len(rest) // 64 * 64
            words, rest = blocks(words, rest[:whole]), rest[whole:]
        if file is not None:
            yield ended()

    return hashed


def _digests(files: DataFrame, parts: DataFrame, scratch: str, turns: int, count: int) -> DataFrame:
    """(file, size, sha256): the hash's state goes from turn to turn, a job for each, in which a
    task reads one file's next bytes."""
    columns = "file int, length bigint, done bigint, bytes binary, sha256 string"
    states = files.selectExpr("file", "length", "0L AS done", "X'' AS bytes")
    for turn in range(turns):
        opening = states.selectExpr("file", "-1L AS start", "0 AS part", "length", "done", "bytes")
        following = parts.filter(F.col("turn") == turn).selectExpr(
            "file", "start", "part", "CAST(NULL AS BIGINT) AS length", "CAST(NULL AS BIGINT) AS done", "bytes"
        )
        rows = opening.unionByName(following).repartitionById(count, "file")
        rows = rows.sortWithinPartitions("file", "start", "part")
        states = rows.mapInArrow(_hasher(turn == turns - 1), columns)
        states = staged(states, scratch, f"turn-{turn}")
    return states.selectExpr("file", "least(done, length) AS size", "sha256")


def _ending(pieces: DataFrame) -> DataFrame:
    """(file, ending): the last ``reach`` bytes of each file of ``length``, of pieces that lie
    ``at`` their places in it."""
    skipped = "greatest(length - reach - at, 0)"
    cut = (
        f"substring(bytes, CAST({skipped} AS INT) + 1,"
        f" CAST(least(octet_length(bytes), length - at) - {skipped} AS INT))"
    )
    found = pieces.filter("at < length AND at + octet_length(bytes) > length - reach")
    found = found.selectExpr("file", "at", f"{cut} AS bytes")
    return found.groupBy("file").agg(F.expr("listagg(bytes) WITHIN GROUP (ORDER BY at)").alias("ending"))


def _footers(files: DataFrame, parts: DataFrame, scratch: str) -> DataFrame:
    """(file, footer): only the parts that a footer lies in leave their task."""
    tails = parts.selectExpr("file", "turn", "start", "part", "n", "tail AS bytes")
    before = Window.partitionBy("file").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, -1)
    placed = staged(tails, scratch, "tails").withColumn("at", F.coalesce(F.sum("n").over(before), F.lit(0)))
    placed = staged(placed.join(F.broadcast(files.select("file", "length")), "file"), scratch, "placed")
    ends = _ending(placed.selectExpr("* EXCEPT (at, n)", "at + n - octet_length(bytes) AS at", "8 AS reach"))
    reach = f"IF(substring(ending, -4, 4) = CAST('PAR1' AS BINARY), {_tail('ending', 'BIGINT')}, 8)"
    ends = ends.selectExpr("file", f"{reach} AS reach")
    needed = placed.drop("bytes").join(F.broadcast(ends), "file").filter("at < length AND at + n > length - reach")
    key = ["file", "turn", "start", "part"]
    last = parts.select(*key, "bytes").join(F.broadcast(needed.drop("n")), key)
    return _ending(last).withColumnRenamed("ending", "footer")


def _large(
    spark: SparkSession, path: str, pattern: str, listed: DataFrame, scratch: str, hashed: bool, footers: bool
) -> DataFrame:
    """The rows of ``_read`` for files over ``WHOLE_BYTES``, written below ``scratch``.

    Spark's text reader gives their bytes by ranges, as lines cut at newline bytes, so that
    no task reads more of them than a range, of ``spark.sql.files.maxPartitionBytes``, up to the
    next newline. They are kept in parts by turn until they are hashed.
    """
    work = f"{scratch}/ranges"
    by_path = Window.orderBy("located")  # names alone, one a large file
    files = staged(listed.withColumn("file", F.row_number().over(by_path) - 1), work, "files")
    count, longest = files.agg(F.count("*"), F.max("length")).first()
    lines = (
        spark.read.option("lineSep", "\n")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .text(path)
        .filter(F.col("_metadata.file_size") > WHOLE_BYTES)
        .selectExpr(
            "_metadata.file_path AS located", "_metadata.file_block_start AS start", "CAST(value AS BINARY) AS line"
        )
        .join(F.broadcast(files.select("located", "file")), "located")
        .select("file", "start", "line")
    )
    parts = lines.mapInArrow(_joiner(PART_BYTES), "file int, start bigint, part int, bytes binary")
    # The ends lie beside the parts, so that a footer's place is found without their bytes.
    parts = parts.selectExpr(
        "*",
        "CAST(octet_length(bytes) AS BIGINT) AS n",
        "substring(bytes, -9, 9) AS tail",
        f"CAST(start DIV {TURN_BYTES} AS INT) AS turn",
    )
    try:
        if hashed:
            parts = staged(parts, work, "parts", by="turn")
            digests = _digests(files, parts, work, (longest - 1) // TURN_BYTES + 1, count)
        else:
            digests = files.selectExpr("file", "length AS size", "CAST(NULL AS STRING) AS sha256")
        ends = (
            _footers(files, parts, work) if footers else files.selectExpr("file", "CAST(NULL AS BINARY) AS footer")
        )
        read = files.join(digests, "file", "left").join(ends, "file", "left")
        return staged(read.select("path", "length", "size", "sha256", "footer"), scratch, "large")
    finally:
        discard(spark, work)


def _tail(content: str, kind: str) -> str:
    """The length of the footer that ``content`` ends with: its last eight bytes are the
    footer's length, lowest byte first, and the format's mark."""
    little = f"hex(substring({content}, -8, 4))"
    big = ", ".join(f"substring({little}, {at}, 2)" for at in (7, 5, 3, 1))
    return f"CAST(conv(concat({big}), 16, 10) AS {kind}) + 8"


def _read(
    spark: SparkSession, path: str, pattern: str, hashed: bool, footers: bool, scratch: str | None
) -> DataFrame:
    """(path, length, size, sha256, footer) of each file: its listed and its read size, and, if
    asked for, its digest and the bytes from its footer on."""
    tail = _tail("content", "INT")
    files = _files(spark, path, pattern)

    def whole(some: DataFrame) -> DataFrame:
        return some.selectExpr(
            "path",
            "length",
            "CAST(octet_length(content) AS BIGINT) AS size",
            ("sha2(content, 256)" if hashed else "CAST(NULL AS STRING)") + " AS sha256",
            (f"substring(content, -({tail}), {tail})" if footers else "CAST(NULL AS BINARY)") + " AS footer",
        )

    longer = files.filter(F.col("length") > WHOLE_BYTES)
    listed = longer.selectExpr("path", "length", "_metadata.file_path AS located")
    if listed.isEmpty():
        return whole(files)
    large = _large(spark, path, pattern, listed, scratch or scratch_folder(spark), hashed, footers)
    return whole(files.filter(F.col("length") <= WHOLE_BYTES)).unionByName(large)


def file_manifest(
    spark: SparkSession,
    path: str,
    pattern: str = "*.parquet",
    hashed: bool = True,
    scratch: str | None = None,
) -> DataFrame:
    """Size, rows, columns, row groups and SHA-256 of each Parquet file under ``path``.

    Spark lists the files, packs them into tasks by size and reads them with its own file
    system settings. Hash and footer of files up to ``WHOLE_BYTES`` are cut from the bytes by
    built-in functions. Larger files are read by ranges at once, and a hash goes on from task to
    task; what is then known of them is kept in ``scratch``. Only footers and larger files'
    ranges reach Python. Without ``hashed`` no digest is computed.
    """
    cut = _read(spark, path, pattern, hashed, True, scratch)
    return cut.select("path", "length", "sha256", "footer").mapInPandas(_describer(_COLUMNS), _SCHEMA)


def hash_checks(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(file_name, num_rows, size_holds, hash_holds): the manifest against a second reading."""
    listed = file_manifest(spark, path, pattern).select(
        "file_path", "file_name", "num_rows", "file_size_bytes", "sha256"
    )
    again = _read(spark, path, pattern, True, False, None).selectExpr("path", "size", "sha256 AS digest")
    return listed.join(again, listed["file_path"] == again["path"], "left").selectExpr(
        "file_name",
        "num_rows",
        "file_size_bytes <=> size AS size_holds",
        "sha256 <=> digest AND sha256 RLIKE '^[0-9a-f]{64}$' AS hash_holds",
    )


def _literal(path: str) -> str:
    """A path that a reader takes as it stands, not as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def verified_trips(
    spark: SparkSession, path: str, listed: DataFrame | None = None
) -> DataFrame:
    """Trips of the Parquet files under ``path``, whose footers may differ.

    A file that holds no rows or lacks a column other than the optional fees is refused by
    name. The rest are scanned with the feed's types, which also reads narrower integers,
    other cases and absent fees; files that store an integer column as doubles are scanned
    with that type and cast.

    ``listed`` is a written ``file_manifest`` of the same files; with it they are not read
    again for their footers. Files of one kind are scanned by ``path`` alone, those of several
    kinds by folder; only a folder that mixes kinds is scanned by its files' names.
    """
    required = [c.lower() for c in TRIP_COLUMNS if c not in OPTIONAL]
    integers = [c.lower() for c, t in TRIP_COLUMNS.items() if t == "bigint"]
    if listed is None:
        scratch = scratch_folder(spark)
        try:
            listed = file_manifest(spark, path, hashed=False, scratch=scratch)
            listed = staged(listed, scratch, "footers")
            return verified_trips(spark, path, listed)
        finally:
            discard(spark, scratch)
    footers = listed.select(
        "file_path",
        "num_rows",
        F.regexp_replace("file_path", "/[^/]*$", "").alias("folder"),
        F.transform("schema_columns", F.lower).alias("names"),
        F.col("schema_types").alias("types"),
    )
    floating = F.filter(
        F.arrays_zip("names", "types"),
        lambda c: c["names"].isin(integers) & c["types"].isin("float", "double"),
    )
    files = footers.select(
        "file_path",
        "folder",
        "num_rows",
        F.array_except(F.array(*map(F.lit, required)), "names").alias("missing"),
        F.array_sort(floating).alias("floating"),
    )
    worst = files.agg(
        F.min(F.struct("num_rows", "file_path")).alias("least"),
        F.max(F.struct(F.size("missing"), "file_path", "missing")).alias("most"),
    ).first()
    if worst["least"] is None:
        raise IncompleteSource(f"{path} holds no rows")
    if not worst["least"]["num_rows"]:
        raise IncompleteSource(f"{worst['least']['file_path']} holds no rows")
    if worst["most"]["missing"]:
        lacks = ", ".join(worst["most"]["missing"])
        raise IncompleteSource(f"{worst['most']['file_path']}: trip columns missing: {lacks}")

    def scanned(kind, reader: DataFrameReader, *paths: str) -> DataFrame:
        stored = {c["names"]: c["types"] for c in kind}
        schema = ", ".join(f"{c} {stored.get(c.lower(), t)}" for c, t in TRIP_COLUMNS.items())
        return conform_trips(reader.schema(schema).parquet(*paths))

    # One kind for each set of integer columns stored as floats: a bounded number.
    kinds = [row["floating"] for row in files.select("floating").distinct().collect()]
    if len(kinds) == 1:
        whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        return scanned(kinds[0], whole, path)
    folders = files.groupBy("folder").agg(
        F.min("floating").alias("floating"), (F.min("floating") == F.max("floating")).alias("pure")
    )
    mixed = folders.filter("NOT pure").select("folder")
    parts = folders.filter("pure").select("floating", F.col("folder").alias("part"), F.lit(True).alias("pure"))
    named = files.join(mixed, "folder").select("floating", F.col("file_path").alias("part"), F.lit(False).alias("pure"))
    found: dict[tuple, tuple] = {}
    for row in parts.unionByName(named).orderBy("part").toLocalIterator():
        kind = found.setdefault(tuple(map(tuple, row["floating"])), (row["floating"], []))
        kind[1].append(_literal(row["part"]) + ("/*.parquet" if row["pure"] else ""))
    scans = [scanned(kind, spark.read, *paths) for kind, paths in found.values()]
    return reduce(DataFrame.unionByName, scans)
