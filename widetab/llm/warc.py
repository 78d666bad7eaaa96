"""WARC writing, and reading by boundary-chain verification (operator 3).

Writing: one record per page through Spark's text sink, whose line separator
is the record end, so each task writes plain WARC files. Of records with
equal payloads of at least ``least`` bytes, the one with the largest page id is
a response and the others are revisits of it.

Reading: Spark's text source splits the archives at every occurrence of the
version line, real or inside a payload. Each task emits its candidates with
the offset at which their declared length says the next record starts. Chains
are followed from offset 0 of each file by pointer jumping (each round joins
the jump table with itself, so r rounds follow 2^r records); only candidates
that are reached are records, and pieces between two records belong to the
former's payload. Only offsets, lengths and digests are shuffled; payloads are
shuffled for records that were cut by a version line inside them, and no
others.

Defined results: null html is an empty payload; null url an empty address; a
null page_id is written as an empty id and read back as null; repeated rows
give a record each (rows that share the largest page_id of a payload all stay
responses); an empty table gives an empty archive and an empty result; other
input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from widetab.llm.common import small_or_shuffled, write_shared

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_BYTES = 1000
RECORDS_PER_FILE = 20_000
MOST_BYTES = (1 << 31) - 1


def _id(c: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                  least: int = LEAST_BYTES, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one WARC record per row below ``path``."""
    base = pages.select(
        F.col(page_id).cast("bigint").alias("id"),
        F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"[\x00-\x20\x7F]", "%20").alias("uri"),
        F.coalesce(F.col(html), F.lit("")).alias("payload"))
    base = base.withColumns({"bytes": F.octet_length("payload"), "sha": F.sha1("payload")})
    groups = write_shared(
        base.filter(F.col("bytes") >= least).groupBy("sha")
        .agg(F.max("id").alias("top"), F.count("*").alias("n")).filter("n > 1 and top is not null")
        .select("sha", "top"), "warc-groups")
    base = base.join(small_or_shuffled(groups, 80), "sha", "left")
    revisit = F.col("top").isNotNull() & (F.col("bytes") >= least) & ~F.col("id").eqNullSafe(F.col("top"))
    head = F.concat(
        F.lit(MAGIC), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _id(F.col("id")), F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "),
        F.col("uri"), F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("sha"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "),
                                 _id(F.col("top")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "))
    body = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("payload")))
    size = F.when(revisit, F.lit(len(HTTP))).otherwise(F.col("bytes") + F.lit(len(HTTP)))
    (base.select(F.concat(head, size.cast("string"), F.lit(END), body).alias("value"))
     .write.option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def _field(head: Column, name: str) -> Column:
    """A header field's value; null where the header has no such line."""
    got = F.regexp_extract(head, rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(got != "", got)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text between version lines: file, split, row order in the split, value."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select("value", F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("split"),
                    F.monotonically_increasing_id().alias("row")))


def _parsed(value: Column) -> dict[str, Column]:
    """What a record's text (after its version line) says: header fields,
    payload length and digest. ``content`` is cut by the declared length."""
    head = F.substring_index(value, END, 1)
    # A declared length is a whole number of bytes that a record can have; payloads may declare anything.
    said = F.expr(f"try_cast(regexp_extract(head, '(?:^|\\r\\n)Content-Length: ([0-9]+)(?=\\r\\n|$)', 1) as bigint)")
    length = F.when((said <= MOST_BYTES) & value.contains(END), said)
    head_bytes = F.octet_length(head).cast("bigint")
    content = F.expr("substring(cast(value as binary), cast(head_bytes + 5 as int), cast(length as int))")
    http = F.octet_length(F.substring_index(content.cast("string"), END, 1)) + len(END)
    payload = F.expr("substring(content, http + 1)")
    return {"head": head, "length": length, "head_bytes": head_bytes, "content": content, "http": http,
            "payload_bytes": F.octet_length(payload).cast("bigint"), "payload_sha": F.sha1(payload)}


def _with_parsed(df: DataFrame) -> DataFrame:
    for name, col in _parsed(F.col("value")).items():
        df = df.withColumn(name, col)
    return df.select("*", _field(F.col("head"), "WARC-Type").alias("type"),
                     F.regexp_extract("head", r"WARC-Record-ID: <urn:page:(-?\d+)>", 1).alias("id"),
                     F.regexp_extract("head", r"WARC-Refers-To: <urn:page:(-?\d+)>", 1).alias("refers"),
                     F.regexp_extract("head", r"WARC-Payload-Digest: sha1:([0-9a-f]{40})", 1).alias("digest"))


SMALL = ["type", "id", "refers", "digest", "payload_bytes", "payload_sha"]


def _affected(again: DataFrame, files: DataFrame) -> DataFrame:
    """(file, start, value) of all pieces of some files, by a read of their own.
    Starts are byte offsets, so they agree with those of any other read."""
    cut = len(MAGIC)
    rows = again.join(small_or_shuffled(files, 300), "file", "left_semi")
    before = F.sum((F.octet_length("value") + cut).cast("bigint")).over(
        W.partitionBy("file").orderBy("split", "row").rowsBetween(W.unboundedPreceding, -1))
    return rows.select("file", (F.coalesce(before, F.lit(0)) - cut).alias("start"), "value")


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every version line of every file: file, start, end (of its piece) and
    ``next``, the start its declared length leads to (null if it has none)."""
    cut = len(MAGIC)
    rows = _with_parsed(_pieces(spark, path)).select(
        "file", "split", "row", (F.octet_length("value") + cut).cast("bigint").alias("span"),
        "head_bytes", "length", *SMALL)
    rows = write_shared(rows, "warc-pieces")
    # Byte offset of a piece: pieces before it in its split, splits before it in its file.
    splits = rows.groupBy("file", "split").agg(F.sum("span").alias("all")).withColumn(
        "base", F.coalesce(F.sum("all").over(W.partitionBy("file").orderBy("split")
                                             .rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    local = F.coalesce(F.sum("span").over(W.partitionBy("file", "split").orderBy("row")
                                          .rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = (rows.withColumn("local", local).join(splits.drop("all"), ["file", "split"])
              .withColumn("start", F.col("base") + F.col("local") - cut))
    placed = placed.filter("start >= 0")          # the empty text before a file's first version line
    jump = F.col("start") + cut + F.col("head_bytes") + len(END) + F.col("length") + len(END)
    return write_shared(placed.select(
        "file", "start", (F.col("start") + F.col("span")).alias("end"),
        F.when(F.col("length").isNotNull() & F.col("type").isNotNull(), jump).alias("next"), *SMALL), "warc-candidates")


def reachable(links: DataFrame) -> DataFrame:
    """(file, start) of candidates that the chain from offset 0 reaches, by
    pointer jumping over (file, start, next). Jumps lead forward, so the rounds
    end after log2 of the longest chain."""
    jumps = links.select("file", "start", "next").filter("next > start")
    heads = links.select("file", "start")
    # A jump that leads to no candidate (end of file, or nowhere) is dropped.
    jumps = write_shared(jumps.join(heads.withColumnRenamed("start", "next"), ["file", "next"], "left_semi"),
                         "warc-jumps")
    marked = write_shared(heads.filter("start = 0"), "warc-marked")
    while True:
        step = marked.withColumnRenamed("start", "s").join(
            jumps, (F.col("s") == jumps["start"]) & (marked["file"] == jumps["file"])).select(
            jumps["file"].alias("file"), F.col("next").alias("start"))
        marked = write_shared(marked.unionByName(step).distinct(), "warc-marked")
        a, b = jumps.alias("a"), jumps.alias("b")
        jumps = write_shared(a.join(b, (F.col("a.file") == F.col("b.file")) & (F.col("a.next") == F.col("b.start")))
                             .select(F.col("a.file").alias("file"), F.col("a.start").alias("start"),
                                     F.col("b.next").alias("next")), "warc-jumps")
        if jumps.isEmpty():
            return marked


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type,
    refers_to, and ``verified`` (payload matches the declared digest)."""
    found = candidates(spark, path)
    real = reachable(found).withColumn("real", F.lit(True))
    marked = found.join(real, ["file", "start"], "left")
    # Pieces up to the next record belong to the record before them.
    owner = F.last(F.when(F.col("real"), F.col("start")), ignorenulls=True).over(
        W.partitionBy("file").orderBy("start"))
    marked = marked.withColumn("owner", owner)
    parts = F.count("*").over(W.partitionBy("file", "owner"))
    marked = write_shared(marked.withColumn("parts", parts), "warc-records")
    whole = marked.filter("real and parts = 1").select(*SMALL)
    # Records whose payload holds a version line are put together from their pieces.
    cut = write_shared(marked.filter("parts > 1 and owner is not null").select("file", "start", "owner"), "warc-cut")
    records = whole
    if not cut.isEmpty():
        pieces = _affected(_pieces(spark, path), cut.select("file").distinct()) \
            .join(small_or_shuffled(cut.withColumnRenamed("start", "at").withColumnRenamed("file", "in"), 300),
                  (F.col("file") == F.col("in")) & (F.col("start") == F.col("at")))
        rebuilt = _with_parsed(pieces.groupBy("file", "owner").agg(
            F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "value"))),
                                                              lambda x: x["value"]), MAGIC).alias("value")))
        rebuilt = write_shared(rebuilt.select("n", *SMALL), "warc-rebuilt")
        got = rebuilt.agg(F.count("*").alias("records"), F.sum("n").alias("pieces")).first()
        asked = cut.agg(F.count_distinct("file", "owner").alias("records"), F.count("*").alias("pieces")).first()
        if got != asked:
            raise RuntimeError(f"archive changed while it was read: {got} of {asked}")
        records = whole.unionByName(rebuilt.select(*SMALL))
    records = write_shared(records, "warc-read")
    records = records.withColumns({"page_id": F.expr("try_cast(id as bigint)"),
                                   "refers_to": F.expr("try_cast(refers as bigint)")})
    # A revisit's length is that of the response it refers to.
    source = (records.filter("type = 'response'").select(F.col("page_id").alias("rid"), "payload_bytes", "payload_sha")
              .groupBy("rid").agg(F.max("payload_bytes").alias("source_bytes"), F.first("payload_sha").alias("source_sha")))
    wanted = records.filter("type = 'revisit'").select(F.col("refers_to").alias("rid")).distinct()
    source = source.join(wanted, "rid", "left_semi")
    out = records.join(small_or_shuffled(write_shared(source, "warc-sources"), 80),
                       (F.col("refers_to") == F.col("rid")) & (F.col("type") == "revisit"), "left")
    is_revisit = F.col("type") == "revisit"
    return out.select(
        "page_id", F.when(is_revisit, F.col("source_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        F.when(is_revisit, F.col("refers_to")).alias("refers_to"),
        (F.when(is_revisit, F.col("source_sha")).otherwise(F.col("payload_sha")) == F.col("digest")).alias("verified"))


def empty_result(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], T._parse_datatype_string(
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, verified boolean"))
