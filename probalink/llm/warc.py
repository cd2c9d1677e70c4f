"""WARC files of web pages, and the audit of their replicas by Merkle trees (operator 7).

The order of a file is that of its records' ids and then hashes. Its tree branches by that order: from the file to ranges of RANGE
ids, to ids, to buckets of equal first digits of the hash (for ids that repeat), to records. A node hashes its children in order, each
as the offset range that it takes in its parent and its own hash. So a node depends on what lies below it and on nothing beside it: a
record that is missing, added or changed changes the nodes above it alone, and two replicas are compared branch by branch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from probalink.llm.common import stored

#: Ids of a file and of a range, and the digits of a hash that name a bucket: a node has at most PER_FILE / RANGE, RANGE or 16 ** DIGITS
#: children, and an id's records are dealt to as many buckets.
PER_FILE, RANGE_BITS, DIGITS = 1024, 5, 3
RANGE = 1 << RANGE_BITS
#: The keys of a node, level by level from the records up. Null ids come after all others (none = 1).
LEVELS = (("file", "none", "range", "id", "bucket", "hash"), ("file", "none", "range", "id", "bucket"), ("file", "none", "range", "id"), ("file", "none", "range"), ("file",))
#: Copies of a record that are counted out at once.
COPIES = 1 << 12
END = "\r\n\r\n"


def record(url: Column, html: Column, number: Column) -> Column:
    """A response record without the two line ends that close it. Null counts as the empty text."""
    body = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"), F.coalesce(html, F.lit("")))
    head = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: ", F.coalesce(url, F.lit("")), "\r\nWARC-Record-ID: <urn:page:", F.coalesce(number.cast("string"), F.lit("none")))
    head += (">\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: ", F.octet_length(body).cast("string"), "\r\n\r\n")
    return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in head], body)


def records(pages: DataFrame, per_file: int = PER_FILE, id_col: str = "page_id") -> DataFrame:
    """(file, id, record): pages as WARC records, `per_file` ids a file. Pages without an id go to files by a hash of their address
    and content, numbered from -1 down."""
    spread = -1 - F.pmod(F.xxhash64("url", "html"), F.lit(1 << 20))
    file = F.coalesce(F.expr(f"(`{id_col}` - pmod(`{id_col}`, {per_file})) div {per_file}"), spread)
    return pages.select(file.cast("long").alias("file"), F.col(id_col).alias("page_id"), record(F.col("url"), F.col("html"), F.col(id_col)).alias("record"))


def write(records: DataFrame, path: str) -> None:
    """Writes records as WARC files, ordered, a folder a file number; a file of very many records is dealt to several parts. The
    separator of Spark's text files is a record's end."""
    ordered = records.repartitionByRange("file", "page_id", F.xxhash64("record")).sortWithinPartitions("file", "page_id", "record")
    ordered.select("file", F.col("record").alias("value")).write.option("lineSep", END).partitionBy("file").text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, page_id, record) of WARC files below path, each read as bytes and cut by the lengths that its records give."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data, at, out = content.as_buffer().to_pybytes(), 0, []
                while at < len(data):
                    body = data.index(b"\r\n\r\n", at) + 4
                    head = dict(line.split(b": ", 1) for line in data[at : body - 4].split(b"\r\n")[1:])
                    end = body + int(head[b"Content-Length"])
                    number = head[b"WARC-Record-ID"].removeprefix(b"<urn:page:").removesuffix(b">")
                    out.append((file, None if number == b"none" else int(number), data[at:end].decode()))
                    at = end + len(END)
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))], ["file", "page_id", "record"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    number = F.regexp_extract("path", r"file=(-?\d+)/", 1).cast("long")
    return files.select(number.alias("file"), "content").mapInArrow(cut, "file long, page_id long, record string")


def leaves(records: DataFrame) -> DataFrame:
    """The lowest level of a tree: (file, none, range, id, bucket, hash, unit, records, length), equal records as one row.

    Records are hashed where they are read, and counted before they are shuffled; unit is the length of one.
    """
    own = records.select("file", "page_id", (F.octet_length("record") + len(END)).cast("long").alias("unit"), F.sha2("record", 256).alias("hash"))
    number = F.coalesce("page_id", F.lit(0)).cast("long")
    keys = [F.col("page_id").isNull().cast("int").alias("none"), F.shiftright(number, RANGE_BITS).alias("range"), number.alias("id"), F.substring("hash", 1, DIGITS).alias("bucket")]
    return own.groupBy("file", *keys, "hash", "unit").agg(F.count("*").alias("records")).withColumn("length", F.col("unit") * F.col("records"))


def placed(nodes: DataFrame, keys: tuple[str, ...], above: tuple[str, ...]) -> DataFrame:
    """nodes with number and offset: the records and bytes of their parent before them."""
    before = Window.partitionBy(*above).orderBy(*keys[len(above) :]).rowsBetween(Window.unboundedPreceding, -1)
    return nodes.withColumns({n: F.coalesce(F.sum(c).over(before), F.lit(0)).cast("long") for n, c in (("number", "records"), ("offset", "length"))})


def parents(nodes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The level above: a node hashes its children's offset ranges and hashes in order."""
    child = F.struct("offset", F.concat_ws(":", F.col("offset").cast("string"), (F.col("offset") + F.col("length")).cast("string"), "hash").alias("range"))
    inside = F.transform(F.array_sort(F.collect_list(child)), lambda c: c["range"])
    return nodes.groupBy(*keys).agg(F.sha2(F.array_join(inside, ","), 256).alias("hash"), F.sum("records").alias("records"), F.sum("length").alias("length"))


def tree(leaf: DataFrame) -> list[DataFrame]:
    """The levels of a tree from the records up to the roots, one a file, each written once. Every node but a root has its number and
    offset within its parent."""
    found, level = [], leaf
    for own, above in zip(LEVELS, LEVELS[1:]):
        found.append(stored(placed(level, own, above), "nodes"))
        level = parents(found[-1], above)
    return [*found, stored(level, "roots")]


def mismatches(left: list[DataFrame], right: list[DataFrame]) -> DataFrame:
    """(file, none, range, id, bucket, hash, left, right): the records that differ in their number between two replicas.

    Roots are compared first; each lower level is compared only below nodes that differ.
    """
    differing = None
    for keys, a, b in zip(reversed(LEVELS), reversed(left), reversed(right)):
        value = F.col("records" if keys == LEVELS[0] else "hash")
        a, b = (x.select(*keys, value.alias(n)) for x, n in ((a, "left"), (b, "right")))
        if differing is not None:
            above = LEVELS[LEVELS.index(keys) + 1]
            a, b = (x.join(differing, list(above), "left_semi") for x in (a, b))
        unequal = a.join(b, list(keys), "full_outer").where("NOT (left <=> right)")
        differing = stored(unequal if keys == LEVELS[0] else unequal.select(*keys), "differing")
    return differing.withColumns({n: F.coalesce(n, F.lit(0)) for n in ("left", "right")})


def audited(replica: DataFrame, other: DataFrame) -> DataFrame:
    """(file, page_id, number, offset, length, hash, root, corrupt) of every record of a replica: corrupt where the other has no equal
    record of that id in that file.

    Repeated records are records of their own: of n copies here and m there, those after the first m are corrupt. What only the other
    replica has changes the roots and is listed by `mismatches`, but is no row of this result. Null addresses, contents and ids have
    their own records too; other columns than those of `records` are not read. An empty replica gives an empty result. A record may
    be as long as a string can.
    """
    left, right = tree(leaves(replica)), tree(leaves(other))
    rows = left[-1].select("file", F.col("hash").alias("root"), F.lit(0).cast("long").alias("number"), F.lit(0).cast("long").alias("offset"))
    for keys, level in zip(LEVELS[-2::-1], left[-2::-1]):  # places in the file, from the roots down
        below = level.select(*keys, *(["unit", "records"] if keys == LEVELS[0] else []), F.col("number").alias("__number"), F.col("offset").alias("__offset"))
        rows = below.join(rows, list(LEVELS[LEVELS.index(keys) + 1]))
        rows = rows.withColumns({"number": F.col("number") + F.col("__number"), "offset": F.col("offset") + F.col("__offset")}).drop("__number", "__offset")
    bad = mismatches(left, right).select(*LEVELS[0], F.col("right").alias("__good"))
    rows = rows.join(bad, list(LEVELS[0]), "left")
    rows = rows.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("records") - 1) / COPIES))))
    last = F.least(F.lit(COPIES).cast("long"), F.col("records") - F.col("__block") * COPIES) - 1
    rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), last))).withColumn("__copy", F.col("__copy") + F.col("__block") * COPIES)
    corrupt = F.coalesce(F.col("__copy") >= F.col("__good"), F.lit(False))
    return rows.select(
        "file", F.when(F.col("none") == 0, F.col("id")).alias("page_id"), (F.col("number") + F.col("__copy")).alias("number"),
        (F.col("offset") + F.col("__copy") * F.col("unit")).alias("offset"), F.col("unit").alias("length"), "hash", "root", corrupt.alias("corrupt"),
    )
